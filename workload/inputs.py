"""Inputs of the operators, derived from the given tables, in Spark and in SQL.

``events`` plays the meter readings: the type of an event is the bidding zone, the user
a site in that zone, the value the consumption; the JSON payload gives power and PUE.
The day-ahead price of a zone and hour is its highest reading of the same hour one day
before, less 30, so some hours have no price and some prices are negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.timejoin import hourly_fact

ZONES = {"view": "PL", "click": "DE_LU", "purchase": "FR", "error": "ES", "signup": "CZ"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    zone = F.lit(None).cast("string")
    for event_type, name in ZONES.items():
        zone = F.when(F.col("event_type") == event_type, name).otherwise(zone)
    e = table(spark, sf, "events").withColumns(
        {"bidding_zone": zone, "k": F.from_json("props", "k int")["k"], "at": F.col("ts").cast("timestamp")}
    )
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("DC-"), F.substring("bidding_zone", 1, 2), F.lit("-"), F.col("user_id")).alias("site_id"),
        F.concat(F.lit("Site "), F.col("user_id")).alias("site_name"),
        F.substring("bidding_zone", 1, 2).alias("country"),
        "bidding_zone",
        F.col("at").alias("timestamp_utc"),
        F.col("value").cast("decimal(10,4)").alias("consumption_kwh"),
        F.col("k").cast("decimal(10,2)").alias("avg_power_kw"),
        (F.lit(1) + F.col("k") / 50).cast("decimal(4,3)").alias("pue"),
        F.lit(3600).alias("reading_interval_s"),
        F.col("at").alias("enqueued_ts"),
        F.col("at").alias("ingestion_ts"),
    )


def _prices(spark: SparkSession, sf: str, slot) -> DataFrame:
    highest = readings(spark, sf).groupBy("bidding_zone", slot.alias("slot")).agg(F.max("consumption_kwh").alias("top"))
    return highest.select(
        "bidding_zone",
        (F.col("slot") + F.expr("interval 1 day")).alias("timestamp_utc"),
        (F.col("top") - 30).cast("decimal(10,2)").alias("price"),
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    return _prices(spark, sf, F.date_trunc("hour", "timestamp_utc"))


def quarter_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The same series by quarter hour: up to four prices in an hour."""
    quarter = F.date_trunc("hour", "timestamp_utc") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.floor(F.minute("timestamp_utc") / 15).cast("int") * 15, F.lit(0)
    )
    return _prices(spark, sf, quarter)


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_fact(readings(spark, sf), prices(spark, sf))


# The same in SQL. Numbers are integers: consumption in 1e-4, price and power in 1e-2, PUE in 1e-3.
READINGS_SQL = """readings as (
    select event_id, 'DC-' || left(zone, 2) || '-' || user_id as site_id, 'Site ' || user_id as site_name,
           left(zone, 2) as country, zone as bidding_zone, ts, date_trunc('hour', ts) as hour_ts,
           cast(round(value * 10000) as bigint) as kwh_u, k * 100 as kw_u, 1000 + k * 20 as pue_u
    from (select *, case event_type when 'view' then 'PL' when 'click' then 'DE_LU' when 'purchase' then 'FR'
                 when 'error' then 'ES' when 'signup' then 'CZ' end as zone,
                 cast(json_extract_string(props, '$.k') as bigint) as k
          from events))"""

PRICES_SQL = """prices as (
    select bidding_zone, hour_ts + interval 1 day as ts, (max(kwh_u) + 50) // 100 - 3000 as price_u
    from readings group by bidding_zone, hour_ts)"""

QUARTER_PRICES_SQL = """prices as (
    select bidding_zone, time_bucket(interval 15 minute, ts) + interval 1 day as ts,
           (max(kwh_u) + 50) // 100 - 3000 as price_u
    from readings group by bidding_zone, time_bucket(interval 15 minute, ts))"""


def fact_sql(prices_sql: str = PRICES_SQL) -> str:
    """Common table expressions up to ``fact``; its measures are in units (suffix ``_u``)."""
    from workload.registry import half_up

    return f"""with {READINGS_SQL}, {prices_sql},
fact as (
    select r.site_id, r.bidding_zone, cast(r.ts as date) as date, cast(hour(r.ts) as int) as hour,
           {half_up("sum(kwh_u)", 4, "count(kwh_u)", 2)} as kwh_u,
           {half_up("sum(kw_u)", 2, "count(kw_u)", 2)} as kw_u,
           {half_up("sum(pue_u)", 3, "count(pue_u)", 3)} as pue_u,
           {half_up("sum(kwh_u * price_u)", 6, "1000 * count(price_u)", 2)} as cost_u
    from readings r left join prices p
      on r.hour_ts = date_trunc('hour', p.ts) and r.bidding_zone = p.bidding_zone
    group by r.bidding_zone, r.site_id, cast(r.ts as date), hour(r.ts))
"""
