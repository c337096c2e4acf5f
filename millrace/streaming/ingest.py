"""Incremental ingest of landing files into a bronze table, with a remembered schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.sources.batches import BatchTable, run_of
from millrace.sources.readers import with_audit
from millrace.sources.schemas import SchemaMemory
from millrace.streaming.rescue import parse_with_rescue, unseen_fields


class SchemaChanged(RuntimeError):
    """A batch holds fields the remembered schema did not know; they are stored now, run again."""


def ingest_json(
    spark: SparkSession,
    landing: str,
    table: BatchTable,
    state: str,
    *,
    hints: StructType | None = None,
    on_new_fields: str = "add",
    files_per_trigger: int = 20,
    as_of: dt.datetime | None = None,
    trigger: Mapping[str, object] | None = None,
) -> None:
    """Drain new JSON-lines files into the table, exactly once.

    The checkpoint remembers the files; a batch that is replayed after a crash overwrites
    what it wrote before. Without its checkpoint a table gets every file again: drop both
    together, as ``safe_reload`` does. ``hints`` fixes the types of known fields from the
    start; an object that is used as a map, with ids as keys, is to be declared as a map
    there, so that its keys never become columns.

    A batch is written under the remembered schema and then looked at: unknown fields end
    up in its rescued data, so the common case costs no extra pass. If there are any, the
    schema is widened and stored; with "add" the batch is written again, with "stop" it is
    taken back and the run fails, and the next run takes it with the new fields.
    """
    if on_new_fields not in ("add", "stop"):
        raise ValueError(f"on_new_fields is {on_new_fields}")
    memory = SchemaMemory(spark, f"{state}/schema")
    if hints is not None and not memory.load().fields:
        memory.save(hints)
    checkpoint = f"{state}/checkpoint"
    run = run_of(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        schema = memory.load()
        while True:
            written = table.write(with_audit(parse_with_rescue(batch, "value", schema), as_of), run, number)
            extra = unseen_fields(written, schema)
            if not extra.fields:
                return
            schema = StructType(schema.fields + extra.fields)
            memory.save(schema)
            if on_new_fields == "stop":
                table.remove(run, number)
                raise SchemaChanged(f"new fields {extra.names}")

    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(landing)
        .select(
            "value",
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_path").alias("source_path"),
        )
        .filter("trim(value) <> ''")
    )
    query = (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


def ingestion_audit(bronze: DataFrame, by: list[str], ts: str = "ingestion_ts") -> DataFrame:
    """Rows and first and last time per source file or load date."""
    return bronze.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
