"""Joins to reference tables by key.

No join hint is used: a side is broadcast only if its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def enrich(df: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Add the lookup's columns; rows without a match keep NULL."""
    return df.join(lookup, on, "left")


def enrich_matched(df: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Add the lookup's columns and drop rows without a match."""
    return df.join(lookup, on, "inner")


def unmatched(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], report: Sequence[str]) -> DataFrame:
    """Distinct report columns of rows that have no match.

    The lookup's keys are made distinct first, so a key that it repeats often is one row
    per task before the shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(lookup.select(*keys).distinct(), keys, "left_anti").select(*report).distinct()
