"""Column profiles: types, NULLs, values, text shapes, ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType


def column_groups(df: DataFrame) -> dict[str, list[str]]:
    """Column names by kind, from the schema alone."""
    groups: dict[str, list[str]] = {"string": [], "numeric": [], "other": []}
    for f in df.schema.fields:
        kind = "string" if isinstance(f.dataType, StringType) else "numeric" if isinstance(f.dataType, NumericType) else "other"
        groups[kind].append(f.name)
    return groups


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: NULLs, and NaNs for floating columns. One pass over the data."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    counts = []
    for i, c in enumerate(df.columns):
        counts.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"u{i}"))
        if c in floating:
            counts.append(F.count_if(F.isnan(f"`{c}`")).alias(f"a{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"u{i}").alias("nulls"),
            (F.col(f"a{i}") if c in floating else F.lit(0).cast("bigint")).alias("nans"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their counts."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def shape_profile(df: DataFrame, column: str, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """Counts per combination of regular-expression extracts: name -> (pattern, group)."""
    parts = [F.regexp_extract(column, p, g).alias(n) for n, (p, g) in patterns.items()]
    return df.select(*parts).groupBy(*patterns).agg(F.count(F.lit(1)).alias("n_rows"))


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: least and greatest value."""
    bounds = [a for c in columns for a in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            # adding zero turns a negative zero into zero
            (F.col(f"lo_{c}").cast("double") + 0.0).alias("min_value"),
            (F.col(f"hi_{c}").cast("double") + 0.0).alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(*bounds).select(F.inline(F.array(*lines)))
