"""Batch and streaming sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from millrace.operators.schema import check_same_columns


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a parquet folder (anything with a slash) or a catalog table, schema included."""
    writer = df.write.mode("overwrite").format("parquet").option("partitionOverwriteMode", "static")
    writer.save(path) if "/" in path else writer.saveAsTable(path)


def append(df: DataFrame, path: str, *, merge_schema: bool = False) -> None:
    """Append to a parquet folder. New columns are refused unless ``merge_schema``.

    Files of different width are read back with ``mergeSchema``.
    """
    if not merge_schema:
        check_same_columns(df.sparkSession.read.parquet(path).schema, df.schema)
    df.write.mode("append").parquet(path)


def insert_overwrite(df: DataFrame, path: str, columns: Mapping[str, DataType | str]) -> None:
    """Replace a table by the named columns, cast to the stored types; overflow raises."""
    overwrite(df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()]), path)


def seed_once(df: DataFrame, path: str) -> bool:
    """Write only if the table is missing or empty; True if it was written."""
    spark = df.sparkSession
    from millrace.sources.files import exists

    if exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    overwrite(df.distinct(), path)
    return True


def truncate(spark: SparkSession, path: str) -> None:
    """Leave an empty table with the same schema."""
    schema = spark.read.parquet(path).schema
    overwrite(spark.createDataFrame([], schema), path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def clone(spark: SparkSession, source: str, target: str) -> None:
    """An independent copy of a parquet table for experiments."""
    overwrite(spark.read.parquet(source), target)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def land_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "json") -> None:
    """One folder per value of ``by``; landing the same slice again replaces just that folder.

    The rebalance hint gathers each slice into few files and lets AQE split a slice
    that is far bigger than the others, so one hot day does not become one task.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def stream_to_files(
    df: DataFrame, path: str, checkpoint: str, *, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Append a stream to parquet, exactly once through checkpoint and sink log.

    ``trigger`` is passed on: ``{"availableNow": True}`` (the default, drain and stop),
    ``{"once": True}`` or ``{"processingTime": "1 minute"}``.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
