"""Join of a measurement series to a price series by hour, and the hourly fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.calendar import hour_bucket
from millrace.functions.decimals import from_units, half_up_mean, half_up_quotient, to_units


def time_bucket_join(
    readings: DataFrame,
    prices: DataFrame,
    *,
    on: str = "bidding_zone",
    ts: str = "timestamp_utc",
    price: str = "price",
    collapse: bool = False,
) -> DataFrame:
    """Each reading with the prices of its hour; NULL price if there is none.

    Several prices in one hour repeat the reading. ``collapse`` joins their average
    instead, so that every reading stays one row.
    """
    p = prices.select(on, hour_bucket(ts).alias("price_hour"), price)
    if collapse:
        p = p.groupBy(on, "price_hour").agg(F.avg(price).alias(price))
    r = readings.withColumn("price_hour", hour_bucket(ts))
    return r.join(p, [on, "price_hour"], "left").select(*readings.columns, price)


def hourly_fact(readings: DataFrame, prices: DataFrame, *, energy_digits: int = 2) -> DataFrame:
    """Site x hour: average consumption, power and PUE, and the average cost of an hour.

    Consumption is rounded to ``energy_digits``: 2 for the report, 4 keeps the digits of a reading.

    Asked for is the average of ``consumption * price / 1000`` over all pairs of a
    reading and a price of its hour. Within one zone and hour every reading meets every
    price, so that average is the product of both averages. Both sides are therefore
    summed up first, combined map-side, and only sums are joined: no reading is repeated,
    and a busy hour or site arrives at the join as a single row.
    """
    r = readings.withColumn("_hour", hour_bucket("timestamp_utc"))
    kwh, kw, pue = (
        F.col("consumption_kwh").cast("decimal(10,4)"),
        F.col("avg_power_kw").cast("decimal(10,2)"),
        F.col("pue").cast("decimal(4,3)"),
    )
    sums = r.groupBy("bidding_zone", "site_id", "_hour").agg(
        F.sum(to_units(kwh, 4)).alias("kwh"),
        F.count("consumption_kwh").alias("n_kwh"),
        F.sum(to_units(kw, 2)).alias("kw"),
        F.count("avg_power_kw").alias("n_kw"),
        F.sum(to_units(pue, 3)).alias("pue"),
        F.count("pue").alias("n_pue"),
    )
    p = prices.groupBy("bidding_zone", hour_bucket("timestamp_utc").alias("_hour")).agg(
        F.sum(to_units(F.col("price").cast("decimal(10,2)"), 2)).alias("price"),
        F.count("price").alias("n_price"),
    )
    pairs = F.col("n_kwh") * F.col("n_price")
    return sums.join(p, ["bidding_zone", "_hour"], "left").select(
        "site_id",
        "bidding_zone",
        F.to_date("_hour").alias("date"),
        F.hour("_hour").alias("hour"),
        half_up_mean(F.col("kwh"), F.col("n_kwh"), 4, energy_digits).alias("avg_consumption_kwh"),
        half_up_mean(F.col("kw"), F.col("n_kw"), 2, 2).alias("avg_power_kw"),
        half_up_mean(F.col("pue"), F.col("n_pue"), 3, 3, 5).alias("avg_pue"),
        from_units(_cost_cents(F.col("kwh"), F.col("price"), pairs), 2, 10).alias("cost_per_hour"),
    )


def _cost_cents(kwh: Column, price: Column, pairs: Column) -> Column:
    """Cents of the average cost: units of 1e-4 kWh times units of 1e-2 per MWh."""
    per_cent = 1000 * 10**4
    narrow = half_up_quotient(kwh * price, pairs * per_cent)
    wide = half_up_quotient(kwh.cast("decimal(19,0)") * price.cast("decimal(18,0)"), (pairs * per_cent).cast("decimal(19,0)"))
    fits = (F.abs(kwh) <= 10**11) & (F.abs(price) <= 10**7)
    return F.when(fits, narrow).otherwise(wide)


def fill_rate(df: DataFrame, column: str) -> DataFrame:
    """All rows, rows with a value, rows without."""
    n, filled = F.count(F.lit(1)), F.count(column)
    return df.agg(n.alias("total"), filled.alias("with_cost"), (n - filled).alias("null_cost"))
