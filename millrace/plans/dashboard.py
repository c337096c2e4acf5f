"""The questions of the energy cost dashboard over the hourly fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import metric_query

Filters = Mapping[str, object] | None


def avg_kwh_by_site_hour(rows: DataFrame, equal: Filters = None) -> DataFrame:
    return metric_query(rows, ["site_id", "hour"], {"avg_kwh": F.avg("avg_consumption_kwh")}, equal=equal)


def avg_pue_by_site_hour(rows: DataFrame, equal: Filters = None) -> DataFrame:
    return metric_query(rows, ["site_id", "hour"], {"avg_pue": F.avg("avg_pue")}, equal=equal)


def total_cost_by_zone(rows: DataFrame, equal: Filters = None) -> DataFrame:
    """Bars in descending order of cost."""
    return metric_query(
        rows, ["bidding_zone"], {"total_cost": F.sum("cost_per_hour")}, equal=equal, order_by="total_cost"
    )


def avg_cost_by_site_date(rows: DataFrame, equal: Filters = None) -> DataFrame:
    return metric_query(rows, ["site_id", "date"], {"avg_cost": F.avg("cost_per_hour")}, equal=equal)


def total_cost_by_weekday(rows: DataFrame, equal: Filters = None) -> DataFrame:
    return metric_query(rows, ["day_of_week_name"], {"total_cost": F.sum("cost_per_hour")}, equal=equal)


def counters(rows: DataFrame, equal: Filters = None) -> DataFrame:
    """Total cost, average PUE, latest date and its weekday."""
    latest = F.max("date")
    return metric_query(
        rows,
        [],
        {
            "total_cost": F.sum("cost_per_hour"),
            "avg_pue": F.avg("avg_pue"),
            "latest_date": latest,
            "latest_weekday": F.date_format(latest, "EEEE"),
        },
        equal=equal,
    )


def monthly_kwh_by_zone(readings: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """Total consumption per zone and calendar month."""
    month = F.date_format(ts, "yyyy-MM").alias("month")
    return readings.groupBy("bidding_zone", month).agg(F.sum("consumption_kwh").alias("total_kwh"))
