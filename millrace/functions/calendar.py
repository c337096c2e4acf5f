"""Hour buckets and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def hour_bucket(ts: Column | str) -> Column:
    return F.date_trunc("hour", ts)


def calendar(dates: DataFrame, column: str = "date") -> DataFrame:
    """One row per distinct date with its calendar attributes; Sunday is day 1."""
    d = F.col("date")
    return (
        dates.select(F.col(column).cast("date").alias("date"))
        .filter("date is not null")
        .distinct()
        .select(
            "date",
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            F.weekofyear(d).alias("week"),
            F.year(d).alias("year"),
            F.dayofweek(d).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_of_week_name"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.quarter(d).alias("quarter"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        )
    )


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """Every date between the first and the last of ``column``, also those without rows."""
    span = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return span.filter("low is not null").select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias(column)
    )
