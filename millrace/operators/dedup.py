"""Duplicates: keep the newest row per key, count them, list them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.ordering import sortable_columns


def _total_order(df: DataFrame, keys: Sequence[str], first: Sequence[str]) -> list:
    """``first`` descending, then every other column that sorts, so that ties have one winner."""
    rest = [c for c in sortable_columns(df) if c not in keys and c not in first]
    return [F.col(f"`{c}`").desc_nulls_last() for c in [*first, *rest]]


def keep_latest(df: DataFrame, keys: Sequence[str], sequence: str | Sequence[str], *, few_copies: bool = False) -> DataFrame:
    """One row per key, the one with the highest ``sequence``; ties go by the other columns.

    ``row_number() = 1`` is planned with a per-partition limit before the shuffle, so a
    key that holds a large share of the rows sends one row per input partition only. That limit
    sorts every row once more; ``few_copies`` leaves it out where no key can have more than a few rows.
    """
    first = [sequence] if isinstance(sequence, str) else list(sequence)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*_total_order(df, keys, first))
    if few_copies:
        return df.withColumn("_newer", F.lag(F.lit(True)).over(w)).filter("_newer is null").drop("_newer")
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with a repeatable choice: the greatest row in column order."""
    return keep_latest(df, keys, [])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, distinct complete keys, and rows beyond the first of a key.

    A key with a NULL part is not counted as a key, like ``COUNT(DISTINCT a, b)``.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return (
        key_counts(df, keys)
        .agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count_if(complete).alias("unique_key"),
        )
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_key"))
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return key_counts(df, keys).filter("n_rows > 1")


def distinct_per_group(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """``COUNT(DISTINCT value)`` per group."""
    return df.groupBy(*group).agg(F.count_distinct(value).alias(name))
