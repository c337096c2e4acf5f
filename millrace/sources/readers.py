"""Batch and streaming scans, provenance and audit columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; give a schema wherever a field may hold mixed types."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A parquet folder (anything with a slash) or a catalog table."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    fmt: str = "json",
    files_per_trigger: int | None = 20,
) -> DataFrame:
    """Incremental scan of a landing folder and the folders in it; folder names are not columns."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def stream_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A parquet folder, or a pattern of paths, read as a stream of appended files."""
    return spark.readStream.schema(schema).parquet(path)


def with_provenance(df: DataFrame) -> DataFrame:
    """Name and path of the file each row came from; call it directly on a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("source_path"),
    )


def with_audit(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """``ingestion_ts`` and ``load_date``; ``as_of`` fixes both so that runs can be compared."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.withColumns({"ingestion_ts": stamp, "load_date": F.to_date(stamp)})
