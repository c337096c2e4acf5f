"""Registered queries: a Spark function and, where SQL can say it, the SQL to compare with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, TimestampNTZType, TimestampType

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    name: str
    run: Run
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        CASES[run.__name__] = Case(run.__name__, lambda spark, sf: portable(run(spark, sf)), sql)
        return run

    return register


def portable(df: DataFrame) -> DataFrame:
    """Types that look alike in every engine: decimals as double, times and booleans as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, BooleanType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def half_up(numerator: str, scale: int, denominator: str, digits: int) -> str:
    """SQL for an integer quotient rounded half up, in units of ``10**-digits``.

    The numerator is an integer in units of ``10**-scale``.
    """
    n, d = f"({numerator})", f"nullif(({denominator}), 0)"
    return (
        f"cast(sign({n}) * ((2 * abs({n}) * {10**digits} + {d} * {10**scale}) "
        f"// (2 * {d} * {10**scale})) as bigint)"
    )


def units(expression: str, digits: int) -> str:
    """SQL for a number of units of ``10**-digits`` as a double."""
    return f"cast({expression} as double) / {10**digits}"
