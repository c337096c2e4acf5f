"""Cleaning of messy incident records and the closed-case report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import cleaning as c
from millrace.functions.decimals import half_up_mean, to_units
from millrace.operators.dedup import drop_duplicates
from millrace.operators.security import drop_personal

# Columns with personal data, removed before anything else.
PERSONAL = (
    "officer_first_name",
    "officer_last_name",
    "officer_id",
    "badge_number",
    "suspect_first_name",
    "suspect_last_name",
    "suspect_id",
    "victim_first_name",
    "victim_last_name",
    "victim_id",
    "victim_phone",
    "address",
    "notes",
)


def clean_incidents(raw: DataFrame) -> DataFrame:
    """One row per incident, with every messy column repaired.

    Repeats go first, by their raw values, so that only rows that stay are parsed.
    """
    df = drop_duplicates(drop_personal(raw, PERSONAL), ["incident_id"])
    df = df.withColumns(
        {
            "incident_datetime": c.parse_timestamp("incident_datetime"),
            "reported_online": c.parse_boolean("reported_online"),
            "num_arrests_flag": c.review_flag("num_arrests"),
            "num_arrests": c.non_negative("num_arrests", 0).cast("int"),
            "property_loss_usd": c.repair_number("property_loss_usd"),
            "case_status": c.standardise("case_status", c.CASE_STATUS, "Unknown"),
            "resolution": c.standardise("resolution", c.RESOLUTION, "Unknown"),
            "suspect_age_group": c.band(c.in_range("suspect_age", 0, 120)),
            "victim_age_group": c.band(c.in_range("victim_age", 0, 120)),
            "suspect_gender": c.standardise_gender("suspect_gender"),
            "victim_gender": c.standardise_gender("victim_gender"),
        }
    ).drop("suspect_age", "victim_age")
    df = df.withColumns(
        {
            "property_loss_usd_flag": c.review_flag("property_loss_usd"),
            "property_loss_usd": c.non_negative("property_loss_usd"),
        }
    )
    return df


def closed_case_report(clean: DataFrame) -> DataFrame:
    """Closed cases with arrests by suspect gender and resolution, most frequent first.

    Losses are averaged as cents, so the result does not depend on the order of addition.
    """
    closed = clean.filter((F.col("case_status") == "Closed") & (F.col("num_arrests") > 0))
    cents = to_units(F.col("property_loss_usd").cast("decimal(14,2)"), 2)
    return (
        closed.groupBy("suspect_gender", "resolution")
        .agg(
            F.count(F.lit(1)).alias("incident_count"),
            half_up_mean(F.sum(cents), F.count(cents), 2, 2, 14).alias("avg_property_loss_usd"),
        )
        .orderBy(F.desc("incident_count"), F.asc_nulls_last("suspect_gender"), "resolution")
    )
