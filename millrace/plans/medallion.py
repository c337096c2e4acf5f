"""Bronze to silver to gold for electricity prices and data-centre meter readings."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from millrace.functions.calendar import calendar
from millrace.operators.dedup import keep_latest
from millrace.operators.history import open_rows
from millrace.operators.quality import check_table, expect_or_drop, expect_or_fail
from millrace.operators.timejoin import hourly_fact
from millrace.session import materialise, side_by_side
from millrace.sources import files
from millrace.sources.batches import BatchTable, run_of
from millrace.sources.slices import SliceTable
from millrace.sources.writers import overwrite
from millrace.spec import Rule, TableSpec
from millrace.streaming.cdc import clean_stream

# Expectations of the pipeline.
PRICE_DROP = (
    Rule("zone_present", "bidding_zone IS NOT NULL"),
    Rule("price_present", "price IS NOT NULL"),
)
READING_DROP = (
    Rule("key_present", "event_id IS NOT NULL"),
    Rule("zone_present", "bidding_zone IS NOT NULL"),
)
READING_FAIL = (
    Rule("pue_valid", "pue BETWEEN 1.0 AND 3.0"),
    Rule("kwh_positive", "consumption_kwh >= 0"),
)
# The stricter range of the gate right after ingest.
GATE_RANGES = (Rule("out_of_range", "NOT (consumption_kwh < 0 OR pue < 1.0 OR pue > 2.0)", null_ok=True),)
EXPECTED_ROWS_PER_DAY = 192

# Columns, types and rules of the silver tables.
PRICES = TableSpec(
    "prices",
    {
        "bidding_zone": "string",
        "timestamp_utc": "timestamp",
        "price": "decimal(10,2)",
        "currency": "string",
        "unit": "string",
        "source_file": "string",
        "ingestion_ts": "timestamp",
        "silver_processed_ts": "timestamp",
    },
    keys=("bidding_zone", "timestamp_utc"),
    not_null=("bidding_zone", "timestamp_utc"),
    checks=(Rule("price_valid", "price BETWEEN -1000 AND 10000"),),
)
READINGS = TableSpec(
    "sensor_data",
    {
        "event_id": "string",
        "timestamp_utc": "timestamp",
        "site_name": "string",
        "country": "string",
        "bidding_zone": "string",
        "consumption_kwh": "decimal(10,4)",
        "pue": "decimal(4,3)",
        "avg_power_kw": "decimal(10,2)",
        "enqueued_ts": "timestamp",
        "ingestion_ts": "timestamp",
        "site_id": "string",
        "reading_interval_s": "int",
        "silver_processed_ts": "timestamp",
    },
    keys=("event_id",),
    not_null=("event_id", "timestamp_utc", "site_id"),
    checks=(
        Rule("pue_valid", "pue >= 1.0 AND pue <= 3.0"),
        Rule("consumption_non_negative", "consumption_kwh >= 0"),
        Rule("interval_positive", "reading_interval_s > 0"),
    ),
)


def _processed(as_of: dt.datetime | None):
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def prices_silver(bronze: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Typed prices with zone and price present, the newest per zone and time."""
    kept = expect_or_drop(bronze, PRICE_DROP)
    latest = keep_latest(kept, PRICES.keys, "ingestion_ts")
    return PRICES.conform(latest.withColumn("silver_processed_ts", _processed(as_of)))


def readings_silver(bronze: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Typed readings inside their domain rules, the newest per event."""
    kept = expect_or_drop(bronze, [*READING_DROP, Rule("time_present", "timestamp_utc IS NOT NULL")])
    typed = kept.withColumns(
        {"pue": F.col("pue").cast("decimal(4,3)"), "consumption_kwh": F.col("consumption_kwh").cast("decimal(10,4)")}
    )
    latest = keep_latest(expect_or_fail(typed, READING_FAIL), READINGS.keys, "ingestion_ts")
    return READINGS.conform(latest.withColumn("silver_processed_ts", _processed(as_of)))


def datacenter_snapshot(readings: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Distinct sites as current dimension rows."""
    return open_rows(readings.select("site_id", "site_name", "country", "bidding_zone"), as_of)


# Columns and types of the hourly fact.
FACT = TableSpec(
    "consumption_hourly",
    {
        "site_id": "string",
        "bidding_zone": "string",
        "date": "date",
        "hour": "int",
        "avg_consumption_kwh": "decimal(10,2)",
        "avg_power_kw": "decimal(10,2)",
        "avg_pue": "decimal(5,3)",
        "cost_per_hour": "decimal(10,2)",
    },
)


def _by(day: Column) -> dict[str, Column]:
    """Readings and fact have the same slices: a zone and a date."""
    return {"zone": F.col("bidding_zone"), "date": day}


@dataclass(frozen=True)
class Lakehouse:
    """Folders of the layers."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def readings(self) -> SliceTable:
        """Silver readings: one row for each event, in the slice of its zone and date."""
        return SliceTable(self.spark, self.path("silver", "sensor_data"), READINGS.schema(), _by(F.to_date("timestamp_utc")))

    def consumption(self) -> SliceTable:
        """The hourly fact of a slice follows from its readings and prices alone."""
        return SliceTable(self.spark, self.path("gold", "consumption_hourly"), FACT.schema(), _by(F.col("date")))

    def event_slices(self) -> BatchTable:
        """For every event the slices it has ever been put into; narrow, so that looking events up does not read silver."""
        return BatchTable(self.spark, self.path("silver", "sensor_data_slices"))

    def read(self, layer: str, name: str) -> DataFrame:
        sliced = {("silver", "sensor_data"): self.readings, ("gold", "consumption_hourly"): self.consumption}.get((layer, name))
        return sliced().read() if sliced else self.spark.read.parquet(self.path(layer, name))

    def store(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        overwrite(df, self.path(layer, name))
        return self.spark.read.schema(df.schema).parquet(self.path(layer, name))


def full_refresh(
    house: Lakehouse, bronze_prices: DataFrame, bronze_readings: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """Rebuild silver and gold from bronze and return the fact.

    Every table is written once and read back, so no step is computed twice and a lost
    executor never reaches back further than the last table. Incremental refreshes can go
    on from there.
    """
    silver = check_table_lazily(readings_silver(bronze_readings, as_of), READINGS)
    prices = check_table_lazily(prices_silver(bronze_prices, as_of), PRICES)
    readings, prices = side_by_side(lambda: materialise(silver, "readings"), lambda: house.store(prices, "silver", "prices"))

    counts = house.readings().counts(readings)

    def consumption() -> DataFrame:
        house.consumption().replace(hourly_fact(readings, prices), counts)
        return _dates(house)

    return side_by_side(
        consumption,
        lambda: house.readings().replace(readings, counts),
        lambda: house.event_slices().replace(_placed(house, readings)),
        lambda: house.store(house.store(datacenter_snapshot(readings, as_of), "silver", "datacenter"), "gold", "dim_datacenter"),
    )[0]


def incremental_refresh(
    house: Lakehouse, bronze_prices: DataFrame, bronze_readings: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """The same with the readings as a stream: only new ones are read, cleaned and merged into silver.

    The rules of the table hold here as in the full refresh. What is read and written of silver
    and of the fact are the zones and dates that new readings, events that move, or changed
    prices touch. A batch that is repeated after a crash merges the same rows into the same slices.
    """
    cleaned = clean_stream(
        bronze_readings,
        {"pue": "decimal(4,3)", "consumption_kwh": "decimal(10,4)"},
        drop=[*READING_DROP, Rule("time_present", "timestamp_utc IS NOT NULL")],
        fail=READING_FAIL,
    )
    silver = check_table_lazily(cleaned.withColumn("silver_processed_ts", _processed(as_of)), READINGS)
    changed = _changed_prices(house, check_table_lazily(prices_silver(bronze_prices, as_of), PRICES))
    checkpoint = house.path("state", "sensor_data")
    run = run_of(house.spark, checkpoint)

    def refresh(batch: DataFrame, number: int) -> None:
        house.event_slices().remove(run, number)  # what an earlier attempt at this batch noted is not known yet
        rows = materialise(keep_latest(batch, READINGS.keys, "ingestion_ts"), "new-readings")
        merged, new_places, touched = _merged(house, rows)
        counts = house.readings().counts(merged)
        side_by_side(
            lambda: _refresh_fact(house, merged, counts, touched),
            lambda: house.readings().put(merged, counts, touched),
            lambda: house.event_slices().write(new_places, run, number),
            lambda: _add_sites(house, rows, as_of),
        )

    query = silver.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if changed:
        held = house.readings().read_slices(changed)
        _refresh_fact(house, held, house.readings().counts(held), changed)
    if not house.consumption().exists():  # nothing has come yet
        house.readings().replace(house.readings().read(), {})
        house.consumption().replace(house.consumption().read(), {})
    house.event_slices().pack()
    return _dates(house)


def _placed(house: Lakehouse, readings: DataFrame) -> DataFrame:
    """Events and the names of their slices."""
    table = house.readings()
    return table.located(readings).select("event_id", *table.by)


def _merged(house: Lakehouse, rows: DataFrame) -> tuple[DataFrame, DataFrame, list[Row]]:
    """What the slices that settled rows touch will hold, what is new for the index, and those slices.

    Touched are the slices of the rows and those in which the index has earlier versions of the same
    events. Only they are read, and settled by the newest of each event.
    """
    table, index = house.readings(), house.event_slices()
    new = now = _placed(house, rows)
    held = now.select(*table.by)
    if index.exists():
        was = {c: f"was_{c}" for c in table.by}
        pairs = now.join(index.read().withColumnsRenamed(was), "event_id", "left")
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(w)) for c, w in was.items()])
        of_event = Window.partitionBy("event_id", *table.by).orderBy(*was.values())  # the join has dealt and sorted by event
        pairs = pairs.withColumns({
            "_noted": F.max(same).over(of_event.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "_place": F.row_number().over(of_event),
        })
        pairs = materialise(pairs, "places-of-events")
        new = pairs.filter("_place = 1 and not _noted").select(now.columns)
        earlier = pairs.filter(F.col(next(iter(was.values()))).isNotNull()).select(*[F.col(w).alias(c) for c, w in was.items()])
        held = pairs.select(*table.by).unionByName(earlier)
    places = held.distinct().collect()
    merged = keep_latest(table.read_slices(places).unionByName(rows), READINGS.keys, "ingestion_ts", few_copies=True)
    return materialise(merged, "merged"), new, places


def _dates(house: Lakehouse) -> DataFrame:
    fact = house.read("gold", "consumption_hourly")
    house.store(calendar(fact), "gold", "dim_date")
    return fact


def _changed_prices(house: Lakehouse, prices: DataFrame) -> list[Row]:
    """Store the new prices; the slices in which they differ from the stored ones, none before any."""
    key = ["bidding_zone", "timestamp_utc", "price"]
    before = None
    if files.exists(house.spark, house.path("silver", "prices")):
        before = materialise(house.read("silver", "prices").select(*key), "prices-before")
    after = house.store(prices, "silver", "prices").select(*key)
    if before is None:
        return []
    return house.readings().slices(before.exceptAll(after).unionByName(after.exceptAll(before)))


def _refresh_fact(house: Lakehouse, readings: DataFrame, counts: dict[tuple, int], places: list[Row]) -> None:
    """The fact of these slices anew, from all their readings and prices; it has rows where they have."""
    by = house.readings().by
    wanted = house.readings().known(places)
    prices = house.readings().located(house.read("silver", "prices")).join(wanted, list(by), "left_semi")
    house.consumption().put(hourly_fact(readings, prices), counts, places)


def _add_sites(house: Lakehouse, rows: DataFrame, as_of: dt.datetime | None) -> None:
    """New sites join the dimension; known ones keep their rows."""
    found = datacenter_snapshot(rows, as_of)
    if files.exists(house.spark, house.path("silver", "datacenter")):
        known = materialise(house.read("silver", "datacenter"), "sites-before")
        key = ["site_id", "site_name", "country", "bidding_zone"]
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key]
        found = known.unionByName(found.alias("n").join(known.alias("k"), same, "left_anti"))
    house.store(house.store(found, "silver", "datacenter"), "gold", "dim_datacenter")


def check_table_lazily(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's rules inside the plan that writes it, instead of a counting pass before."""
    return expect_or_fail(spec.conform(df), spec.rules())


__all__ = [
    "EXPECTED_ROWS_PER_DAY",
    "GATE_RANGES",
    "Lakehouse",
    "PRICES",
    "READINGS",
    "check_table",
    "datacenter_snapshot",
    "full_refresh",
    "incremental_refresh",
    "prices_silver",
    "readings_silver",
]
