"""Averages of decimals in whole units of their last digit, rounded once, half up.

Decimal division cuts the quotient to a fixed scale and a later cast rounds a second
time; sums of doubles depend on the order of addition. Counting in units avoids both,
and bigint arithmetic is several times faster than that of wide decimals.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def to_units(c: Column, digits: int) -> Column:
    """A decimal with at most ``digits`` decimals as a bigint of units ``10**-digits``."""
    return (c * F.lit(10**digits)).cast("bigint")


def from_units(units: Column, digits: int, precision: int) -> Column:
    """Units as ``decimal(precision, digits)``; overflow raises."""
    whole = units.cast(f"decimal({precision},0)")
    return (whole * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal({precision},{digits})")


def half_up_quotient(numerator: Column, denominator: Column) -> Column:
    """The quotient of two integers (bigint or decimal without decimals) as bigint, halves
    away from zero; NULL without a denominator."""
    whole = F.call_function("div", F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.when(denominator > 0, F.when(numerator < 0, -whole).otherwise(whole))


def half_up_mean(units: Column, count: Column, unit_digits: int, digits: int, precision: int = 10) -> Column:
    """A sum of units ``10**-unit_digits`` over a count, as ``decimal(precision, digits)``."""
    mean = half_up_quotient(units, count * F.lit(10 ** (unit_digits - digits)))
    return from_units(mean, digits, precision)
