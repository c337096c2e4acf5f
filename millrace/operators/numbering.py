"""Dense, unique, ascending row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.ordering import sortable_columns
from millrace.session import materialise


def number_rows(
    df: DataFrame, key: str, name: str, *, start: Column | int = 1, within: Sequence[str] = ()
) -> DataFrame:
    """Number rows in the order of ``key``, from ``start`` on; equal keys go by the other columns.

    NULL comes first, NaN last. With ``within`` every group of those columns is numbered by
    itself. Rows are range-partitioned by the whole order and written once, with their place
    in their partition; a partition then adds what lies before it, which takes one small row
    per partition and group. Rows that are alike in every column are told apart by their
    place in the input, so even they are spread over the tasks.
    """
    order = [*within, key, *(c for c in sortable_columns(df) if c not in {key, *within})]
    ascending = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    place = _unused(df, "_place")
    placed = (
        df.withColumn(place, F.monotonically_increasing_id())
        .repartitionByRange(*ascending, place)
        .sortWithinPartitions(*ascending, place)
        .withColumn(place, F.monotonically_increasing_id())  # the task above 33 bits for the row in it
    )
    stored = materialise(placed, "numbered").alias("r")

    task = F.shiftright(F.col(place), 33)
    groups = [F.col(f"`{c}`") for c in within]
    parts = stored.groupBy(task.alias("_task"), *groups).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).alias("o")
    same = task == F.col("o._task")
    for c in within:
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`"))
    first = start if isinstance(start, Column) else F.lit(start)
    number = F.col(f"r.{place}") - F.col("o._first") + F.col("o._before") + first
    return stored.join(offsets, same).select(
        *[F.col(f"r.`{c}`") for c in df.columns], number.cast("bigint").alias(name)
    )


def _unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
