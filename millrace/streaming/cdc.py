"""Change capture into a table of batches, and the cleaning step before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from millrace.operators.dedup import keep_latest
from millrace.operators.quality import expect_or_drop, expect_or_fail
from millrace.sources.batches import BatchTable, run_of
from millrace.spec import Rule


def clean_stream(df: DataFrame, casts: Mapping[str, str], drop: Sequence[Rule], fail: Sequence[Rule]) -> DataFrame:
    """Casts, rules that drop rows, then rules that stop the run. Stateless."""
    typed = df.withColumns({c: df[c].cast(t) for c, t in casts.items()})
    return expect_or_fail(expect_or_drop(typed, drop), fail)


def apply_changes_stream(
    changes: DataFrame, table: BatchTable, *, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> None:
    """Add every change to the table, exactly once.

    A batch is written and nothing is rewritten, whatever the size of the table. Late rows
    need no watermark: ``current`` lets the highest sequence of a key win, in whatever
    order the changes came.
    """
    run = run_of(table.spark, checkpoint)

    def add(batch: DataFrame, number: int) -> None:
        table.write(batch, run, number)

    query = (
        changes.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


def current(table: BatchTable, keys: Sequence[str], sequence: str) -> DataFrame:
    """The newest row of every key."""
    return keep_latest(table.read(), keys, sequence)


def settle(table: BatchTable, target: str, keys: Sequence[str], sequence: str) -> DataFrame:
    """Write the current rows to a fresh folder, for readers that come often."""
    rows = current(table, keys, sequence)
    rows.write.mode("errorifexists").parquet(target)
    return table.spark.read.schema(rows.schema).parquet(target)
