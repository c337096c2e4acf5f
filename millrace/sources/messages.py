"""Message-log source: binary values with partition, offset and time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

ENVELOPE = "value binary, partition int, offset bigint, timestamp timestamp"

# The fields of a meter message.
READING_SCHEMA = (
    "event_id string, schema_version int, site_id string, site_name string, country string, "
    "bidding_zone string, timestamp_utc string, consumption_kwh double, avg_power_kw double, "
    "pue double, reading_interval_s int"
)


def message_stream(
    spark: SparkSession,
    options: Mapping[str, str],
    *,
    fmt: str = "kafka",
    path: str | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """A stream of message envelopes from the earliest offset on.

    ``kafka`` needs Spark's Kafka package on the class path. A file format with a
    ``path`` reads recorded envelopes of the same shape.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", options.get("startingOffsets", "earliest"))
        return reader.option("failOnDataLoss", str(fail_on_data_loss).lower()).load()
    return reader.schema(ENVELOPE).load(path)


def parse_messages(raw: DataFrame, schema: StructType | str = READING_SCHEMA) -> DataFrame:
    """Body as JSON under an explicit schema, flattened, next to where and when it was queued."""
    return raw.select(
        F.from_json(F.col("value").cast("string"), schema).alias("e"),
        "partition",
        "offset",
        F.col("timestamp").alias("enqueued_ts"),
    ).select("e.*", "partition", "offset", "enqueued_ts")
