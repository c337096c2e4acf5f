"""File layouts for data skipping, compaction and reports on both."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.ordering import cuts, interleave, slot_of, sortable_columns, with_hilbert_value
from millrace.sources import files

TARGET_BYTES = 256 * 1024 * 1024
ROWS_PER_FILE = 1_000_000  # one task shuffles, sorts and writes them
LOOKUP_ERROR = 0.001  # share of row groups that a lookup reads in vain


def scatter(df: DataFrame, n_files: int) -> DataFrame:
    """The unclustered baseline: rows spread evenly, every file spans the whole key range."""
    return df.repartition(n_files)


def with_curve_value(df: DataFrame, name: str, keys: Sequence[str], bits: int, curve: str = "z") -> DataFrame:
    """Add the place of a row on the Z or the Hilbert curve through one to four columns, ``2**bits`` slots each."""
    if not 1 <= len(keys) <= 4:
        raise ValueError("one to four clustering keys")
    if curve not in ("z", "hilbert"):
        raise ValueError(f"curve is {curve}")
    slots = [slot_of(k, df.schema[k].dataType, cuts(df, k, 2**bits)) for k in keys]
    return with_hilbert_value(df, name, slots, bits) if curve == "hilbert" else df.withColumn(name, interleave(slots, bits))


def bits_for(n_files: int, n_keys: int) -> int:
    """Bits per key so that the curve has several cells for every file."""
    return min(62 // n_keys, max(4, math.ceil(math.log2(max(n_files, 2)) / n_keys) + 2))


def cluster(df: DataFrame, keys: Sequence[str], n_files: int, bits: int | None = None, *, curve: str = "z") -> DataFrame:
    """Rows range-partitioned and sorted by one key, or along a curve through several, ``z`` or ``hilbert``.

    Inside a cell of the curve the keys themselves decide. A hash of the row comes last in
    the range, so that rows with equal keys, however many, are still cut into several files.
    """
    z, spread = (next(n for n in (c, f"_{c}", f"__{c}") if n not in df.columns) for c in ("_z", "_spread"))
    placed = with_curve_value(df, z, keys, bits or bits_for(n_files, len(keys)), curve) if len(keys) > 1 else df.withColumn(z, F.lit(0))
    return (
        placed.withColumn(spread, F.xxhash64(*[F.col(f"`{c}`") for c in sortable_columns(df)]))
        .repartitionByRange(n_files, z, *keys, spread)
        .sortWithinPartitions(z, *keys)
        .drop(z, spread)
    )


def write_layout(
    df: DataFrame, path: str, bounds: Sequence[str] = (), *, lookup: Sequence[str] = (), rows_per_file: int = 1_000_000
) -> None:
    """Write a table; with ``bounds`` also the least and greatest values of these columns per file, beside it.

    The columns of ``lookup`` get Parquet Bloom filters, sized for ``rows_per_file`` values: a lookup by one
    value then reads only the row groups that may hold it, wherever its rows lie.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    for c in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True).option(f"parquet.bloom.filter.fpp#{c}", LOOKUP_ERROR)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", rows_per_file)
    writer.parquet(path)
    files.delete(df.sparkSession, _bounds_of(path))  # those of the files before
    if bounds:
        _extend_bounds(df.sparkSession, path, bounds)


def _bounds_of(path: str) -> str:
    return f"{path.rstrip('/')}-bounds"


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes of every data file. Files are listed, not opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return listing.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"), "path")


def file_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row per file: its name, its size and the least and greatest value of each column, from a scan of these columns."""
    return _scanned(spark.read.parquet(path), columns)


def _scanned(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    limits = [a for c in columns for a in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    rows = table.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), *columns)
    return rows.groupBy("file", "bytes").agg(*limits)


def current_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``file_bounds`` of the files that the table has now: the stored ones where a file has them, the others are scanned.

    So the answer is right whoever wrote, appended or removed files, and only unknown ones are opened.
    """
    names = ["file", "bytes", *[f"{end}_{c}" for c in columns for end in ("lo", "hi")]]
    if not files.exists(spark, _bounds_of(path)):
        return file_bounds(spark, path, columns).select(*names)
    stored = spark.read.parquet(_bounds_of(path))
    if not set(names) <= set(stored.columns):
        return file_bounds(spark, path, columns).select(*names)
    listed = _listing(spark, path)
    known = stored.join(listed, ["file", "bytes"], "left_semi").select(*names)
    unknown = [r.path for r in listed.join(stored, ["file", "bytes"], "left_anti").select("path").collect()]  # files of later writers
    return known.unionByName(_scanned(spark.read.parquet(*unknown), columns).select(*names)) if unknown else known


def _extend_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Store the bounds of the files that have none yet."""
    found = current_bounds(spark, path, columns)
    if files.exists(spark, _bounds_of(path)):
        found = found.join(spark.read.parquet(_bounds_of(path)), ["file", "bytes"], "left_anti")
    found.write.mode("append").parquet(_bounds_of(path))


def append_clustered(df: DataFrame, path: str, keys: Sequence[str], n_files: int) -> None:
    """Add a batch clustered by its own keys; files written before keep their layout, stored bounds follow."""
    cluster(df, keys, n_files).write.mode("append").parquet(path)
    spark = df.sparkSession
    if files.exists(spark, _bounds_of(path)):
        columns = [c.removeprefix("lo_") for c in spark.read.parquet(_bounds_of(path)).columns if c.startswith("lo_")]
        _extend_bounds(spark, path, columns)


def overlaps(bounds: Mapping[str, tuple[object, object]]) -> Column:
    """Whether the bounds of a file overlap a box, closed on all sides, in every column."""
    hit = F.lit(True)
    for c, (low, high) in bounds.items():
        hit = hit & (F.col(f"lo_{c}") <= F.lit(high)) & (F.col(f"hi_{c}") >= F.lit(low))
    return F.coalesce(hit, F.lit(False))


def boxes_report(spark: SparkSession, tables: Mapping[str, str], boxes: Sequence[Mapping[str, tuple[object, object]]]) -> DataFrame:
    """Per table how many files all boxes must read together, and how many there are to read: one pass over its bounds."""
    columns = list(boxes[0])
    parts = []
    for name, path in tables.items():
        read = reduce(Column.__add__, [F.count_if(overlaps(box)) for box in boxes])
        row = current_bounds(spark, path, columns).agg(read.alias("files_read"), (F.count(F.lit(1)) * len(boxes)).alias("files_total"))
        parts.append(row.select(F.lit(name).alias("table_name"), "files_read", "files_total"))
    return reduce(DataFrame.unionByName, parts)


def layout_report(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Files and bytes per table. Files are listed, not opened."""
    parts = []
    for name, path in tables.items():
        parts.append(
            _listing(spark, path).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("num_files"),
                F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("size_in_bytes"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def skipping_report(
    spark: SparkSession, tables: Mapping[str, str], bounds: Mapping[str, tuple[object, object]]
) -> DataFrame:
    """How many files a closed-range predicate must read: those whose least and greatest
    values overlap it in every column. Bounds written with the table are used; files
    without them are scanned for the predicate columns."""
    parts = []
    for name, path in tables.items():
        hit = overlaps(bounds)
        parts.append(
            current_bounds(spark, path, list(bounds)).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("files_total"),
                F.count_if(hit).alias("files_read"),
                F.coalesce(F.sum(F.when(~hit, F.col("bytes"))), F.lit(0)).cast("bigint").alias("bytes_pruned"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of a collected plan without shuffles gave to their filters: what skipping left to read."""
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
        metric = plan.metrics().get("numOutputRows")
        if children.isEmpty() and metric.isDefined():
            total += metric.get().value()
    return total


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = TARGET_BYTES,
    keys: Sequence[str] | None = None,
) -> None:
    """Merge small files into files of about ``target_bytes``.

    Without keys there is no shuffle: read partitions are joined until there are as many
    as files. That mixes files of a clustered table, which is therefore given its ``keys``
    and clustered anew.
    """
    if keys:
        total = layout_report(spark, {"source": source}).first().size_in_bytes
        write_layout(cluster(spark.read.parquet(source), keys, files_for(total, target_bytes)), target)
        return
    total = layout_report(spark, {"source": source}).first().size_in_bytes
    write_layout(spark.read.parquet(source).coalesce(files_for(total, target_bytes)), target)


def files_for(total_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    """How many files a rewrite of that size should have."""
    return max(1, math.ceil(total_bytes / target_bytes))


def files_for_rows(n_rows: int, least: int = 1) -> int:
    """How many files a layout of so many rows should have, so that no task's share grows with the table."""
    return max(least, math.ceil(n_rows / ROWS_PER_FILE))
