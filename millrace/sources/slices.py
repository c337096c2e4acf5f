"""A table in slices: one folder for each, so that a merge reads and rewrites only those it touches.

Slices are named by columns of their own, whose values are safe in a folder name; the columns they
come from stay in the files, with their types. A folder is found by its name, without listing the table.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.sources import files

PREFIX = "slice_"
ROWS_PER_FILE = 2_000_000


def folder_name(value: Column) -> Column:
    """A value as part of a folder name, reversible; no store has to escape anything in it.

    Most values have nothing to escape, and to see that is much cheaper than to escape them.
    """
    text = value.cast("string")
    plain = text.rlike(r"^[A-Za-z0-9._-]+\z")
    safe = F.replace(F.replace(F.url_encode(text), F.lit("%"), F.lit("~")), F.lit("*"), F.lit("~2A"))
    return F.when(value.isNull(), "~null").when(plain, text).when(text == "", "~").otherwise(safe)


class SliceTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Mapping[str, Column]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.by = {f"{PREFIX}{name}": value for name, value in by.items()}

    def exists(self) -> bool:
        return files.exists(self.spark, self.path)

    def located(self, df: DataFrame) -> DataFrame:
        """With the columns that name a row's slice."""
        return df.withColumns({name: folder_name(value) for name, value in self.by.items()})

    def slices(self, df: DataFrame) -> list[Row]:
        """The slices that the rows lie in; one row each, as there is one folder each."""
        return [Row(**dict(zip(self.by, place))) for place in self.counts(df)]

    def known(self, rows: Iterable[tuple], *more: str) -> DataFrame:
        """Slices and what is known of them, as a constant of the plan: no Python worker starts for it."""
        fields = [*[f"{c} string" for c in self.by], *more]
        names = [f.split(" ")[0] for f in fields]
        text = json.dumps([dict(zip(names, row)) for row in rows])
        parsed = F.from_json(F.lit(text), f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in fields)}>>")
        return self.spark.range(0, 1, 1, 1).select(F.inline(parsed))

    def folder(self, place: Row) -> str:
        return "/".join([self.path, *[f"{name}={place[name]}" for name in self.by]])

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self._files(self.path)

    def read_slices(self, places: Iterable[Row]) -> DataFrame:
        """The rows of these slices; no other folder is listed or opened."""
        found = [f for f in map(self.folder, places) if files.exists(self.spark, f)]
        return self._files(*found) if found else self.spark.createDataFrame([], self.schema)

    def _files(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(*paths)

    def counts(self, df: DataFrame) -> dict[tuple, int]:
        """Rows in each slice; one entry per folder. Folder names are made for each value, not for each row."""
        values = df.groupBy(*[value.cast("string").alias(name) for name, value in self.by.items()]).count()
        found = values.withColumns({name: folder_name(F.col(name)) for name in self.by}).collect()
        totals: dict[tuple, int] = {}
        for r in found:
            totals[tuple(r)[:-1]] = totals.get(tuple(r)[:-1], 0) + r["count"]
        return totals

    def replace(self, df: DataFrame, counts: Mapping[tuple, int]) -> None:
        """All rows anew. ``counts`` has the slices of ``df`` and about how many rows each holds."""
        self._write(df, counts, "static")

    def put(self, df: DataFrame, counts: Mapping[tuple, int], places: Iterable[Row]) -> None:
        """These rows for their slices, which ``counts`` names; of ``places`` those that are not among them go.

        ``df`` must not read the slices it replaces. A run that is repeated after a crash puts the same
        rows into the same folders.
        """
        if counts:
            self._write(df, counts, "dynamic")
        for place in places:
            if tuple(place) not in counts:
                files.delete(self.spark, self.folder(place))

    def _write(self, df: DataFrame, counts: Mapping[tuple, int], mode: str) -> None:
        """Every slice by one task, or a large one by several, so that no folder gets many small files."""
        rows = self.located(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]))
        tasks, dealt = _dealt(counts, self.spark.sparkContext.defaultParallelism)
        task = F.pmod(F.xxhash64(*self.by), F.lit(tasks))  # of a slice that counts lacks
        if dealt:
            known = self.known([(*place, own) for place, own in dealt.items()], "_tasks array<int>")
            rows = rows.join(F.broadcast(known), list(self.by), "left")
            salt = F.lit(0)
            if any(len(own) > 1 for own in dealt.values()):
                whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in self.schema.fields])
                salt = F.pmod(whole, F.size("_tasks"))
            task = F.coalesce(F.get("_tasks", salt.cast("int")), task)
        rows = rows.withColumn("_task", task.cast("int")).drop("_tasks").repartitionById(tasks, "_task").drop("_task")
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*self.by).parquet(self.path)


def _dealt(counts: Mapping[tuple, int], cores: int) -> tuple[int, dict[tuple, list[int]]]:
    """How many tasks write, and the tasks that share each slice: the next largest part goes to the task with the fewest rows.

    A writer sorts all rows of its task, so a task gets about the rows of one file, however large the table.
    """
    shares = {place: max(1, -(-n // ROWS_PER_FILE)) for place, n in counts.items()}
    parts = sorted(((counts[place] / k, place) for place, k in shares.items() for _ in range(k)), reverse=True)
    tasks = max(1, min(len(parts), max(cores, len(parts) // 4, 2 * sum(counts.values()) // ROWS_PER_FILE)))
    loads = [(0.0, task) for task in range(tasks)]
    dealt: dict[tuple, list[int]] = {}
    for size, place in parts:
        load, task = heapq.heappop(loads)
        dealt.setdefault(place, []).append(task)
        heapq.heappush(loads, (load + size, task))
    return tasks, dealt
