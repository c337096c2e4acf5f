"""Full reload of a streamed table without a moment in which it is empty."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import files


class ReloadMismatch(RuntimeError):
    """The reloaded table has another row count than the one in use."""


@dataclass(frozen=True)
class Generation:
    """Table and checkpoint that belong together; one without the other loses or repeats rows."""

    root: str
    number: int

    @property
    def table(self) -> str:
        return f"{self.root}/gen={self.number:06d}/table"

    @property
    def state(self) -> str:
        return f"{self.root}/gen={self.number:06d}/state"


def current_generation(spark: SparkSession, root: str) -> Generation:
    kept = files.names(spark, f"{root}/current")
    return Generation(root, int(kept[-1]) if kept else 0)


def safe_reload(
    spark: SparkSession,
    root: str,
    ingest: Callable[[Generation], None],
    read: Callable[[Generation], DataFrame],
    *,
    same_rows: bool = True,
) -> tuple[int, int]:
    """Ingest everything into a fresh table with a fresh checkpoint, then switch readers over.

    Returns the row counts before and after. If they must be the same and are not, the
    table in use stays.
    """
    old = current_generation(spark, root)
    new = Generation(root, old.number + 1)
    before = read(old).count()
    ingest(new)
    after = read(new).count()
    if same_rows and before != after:
        raise ReloadMismatch(f"{before} rows before, {after} after")
    files.create_text(spark, f"{root}/current/{new.number:06d}", "")
    return before, after
