"""A table that a stream fills: one folder for each of its batches.

A batch that is replayed after a crash overwrites its own folder, so it is never added
twice. Batch numbers mean something only within one checkpoint, so a checkpoint has a
folder of its own. Readers see all batches; what a key's current row is, they settle with
``keep_latest``. Small batches are packed into few files while streams write and read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import files
from millrace.sources.schemas import SchemaMemory

RUN, BATCH = "stream_run", "stream_batch"
TARGET_BYTES = 128 << 20
PACKED = re.compile(r"_packed-(\d+)-(\d+)")  # the batches that a folder holds are in its name


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with a checkpoint."""
    path = f"{checkpoint}/run-name"
    if not files.exists(spark, path):
        files.create_text(spark, path, uuid.uuid4().hex)
    return files.read_text(spark, path)


def first_fit(sizes: Sequence[int], target: int) -> list[list[int]]:
    """Indices in bins of up to ``target`` bytes, the largest first into the first bin that has room."""
    bins: list[list[int]] = []
    room: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), None)
        if k is None:
            bins.append([i])
            room.append(target - sizes[i])
        else:
            bins[k].append(i)
            room[k] -= sizes[i]
    return bins


class BatchTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = SchemaMemory(spark, f"{self.path}/_schema")

    def folder(self, run: str, batch: int) -> str:
        return f"{self.path}/{RUN}={run}/{BATCH}={batch:012d}"

    def _runs(self) -> list[str]:
        return [n for n in files.names(self.spark, self.path) if n.startswith(f"{RUN}=")]

    def _run(self, run: str) -> tuple[list[str], list[tuple[int, int, str]]]:
        """Names of the batches that stand alone, and first, last and name of what is packed."""
        names = files.names(self.spark, f"{self.path}/{run}")
        packed = [(int(m[1]), int(m[2]), n) for n in names if (m := PACKED.fullmatch(n))]
        alone = [n for n in names if n.startswith(f"{BATCH}=") and not any(a <= _number(n) <= b for a, b, _ in packed)]
        return alone, packed

    def exists(self) -> bool:
        """Whether a batch was ever completed."""
        for run in self._runs():
            alone, packed = self._run(run)
            if packed or any(n.startswith("part-") for b in alone for n in files.names(self.spark, f"{self.path}/{run}/{b}")):
                return True
        return False

    def write(self, df: DataFrame, run: str, batch: int) -> DataFrame:
        """Write a batch, over what an earlier attempt may have left, and read it back."""
        if any(a <= batch <= b for a, b, _ in self._run(f"{RUN}={run}")[1]):
            raise ValueError(f"batch {batch} is packed already")
        self.schemas.widen(df.schema)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.folder(run, batch))
        return self.spark.read.schema(df.schema).parquet(self.folder(run, batch))

    def remove(self, run: str, batch: int) -> None:
        files.delete(self.spark, self.folder(run, batch))

    def replace(self, df: DataFrame) -> None:
        """The rows as the only batch."""
        files.delete(self.spark, self.path)
        self.write(df, uuid.uuid4().hex, 0)

    def read(self) -> DataFrame:
        """All rows of all batches; a column that a batch lacks is NULL for it."""
        paths = []
        for run in self._runs():
            alone, packed = self._run(run)
            paths += [f"{self.path}/{run}/{n}" for n in [*alone, *[n for _, _, n in packed]]]
        schema = self.schemas.load()
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)

    def drain(self, reader: str, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
        """Hand over, as a stream, all rows that the reader has not seen, and note how far it came.

        Batches that a reader of the table has not seen are never packed.
        """
        reached = {run: max(map(_number, self._run(run)[0]), default=-1) for run in self._runs()}
        self._note(reader, {})
        source = self.spark.readStream.schema(self.schemas.load()).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        stream = source.parquet(self.path).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
        self._note(reader, reached)

    def _note(self, reader: str, reached: dict[str, int]) -> None:
        """How far a reader came in each run; the first note only makes it known."""
        folder = f"{self.path}/_readers/{reader}"
        if not reached and files.exists(self.spark, folder):
            return
        number = len(files.names(self.spark, folder))
        files.create_text(self.spark, f"{folder}/{number:012d}", "\n".join(f"{b} {run}" for run, b in reached.items()))

    def _seen_by_all(self, run: str) -> int | None:
        """The last batch of a run that every reader has seen; None without readers."""
        seen = []
        for reader in files.names(self.spark, f"{self.path}/_readers"):
            folder = f"{self.path}/_readers/{reader}"
            lines = files.read_text(self.spark, f"{folder}/{files.names(self.spark, folder)[-1]}").splitlines()
            seen.append(max((int(b) for b, r in (line.split(" ", 1) for line in lines) if r == run), default=-1))
        return min(seen, default=None)

    def pack(self, target_bytes: int = TARGET_BYTES) -> int:
        """Put small batches into files of about ``target_bytes`` and return how many files that made.

        Files are packed whole, without a shuffle: one task reads those of a bin and writes one file. The
        newest batch of a run stays, as its writer may replay it, and so does what a reader has yet to
        see. The new folder appears by one rename under a name that streams pass over; from then on
        it stands for the batches in its name, whether or not their folders are gone yet.
        """
        made = 0
        for run in self._runs():
            root = f"{self.path}/{run}"
            alone, packed = self._run(run)
            for first, last, _ in packed:  # what an earlier attempt left behind
                for name in files.names(self.spark, root):
                    if name.startswith(f"{BATCH}=") and first <= _number(name) <= last:
                        files.delete(self.spark, f"{root}/{name}")
            seen = self._seen_by_all(run)
            ready = [n for n in sorted(alone)[:-1] if seen is None or _number(n) <= seen]
            held = {n: [f for f in files.sizes(self.spark, f"{root}/{n}") if f[1] > 0] for n in ready}
            for names in _stretches(ready, {n: sum(s for _, s in f) < target_bytes for n, f in held.items()}):
                parts = [f for n in names for f in held[n]]
                bins = first_fit([size for _, size in parts], target_bytes)
                schema = self.schemas.load()
                drafts = [self.spark.read.schema(schema).parquet(*[parts[i][0] for i in b]).coalesce(1) for b in bins]
                draft = f"{root}/.draft-{uuid.uuid4().hex}"
                rows = reduce(DataFrame.unionByName, drafts) if drafts else self.spark.createDataFrame([], schema)
                rows.write.parquet(draft)
                files.rename(self.spark, draft, f"{root}/_packed-{_number(names[0]):012d}-{_number(names[-1]):012d}")
                for name in names:
                    files.delete(self.spark, f"{root}/{name}")
                made += len(bins)
        return made


def _number(name: str) -> int:
    return int(name.rsplit("=", 1)[1])


def _stretches(names: Sequence[str], small: dict[str, bool]) -> list[list[str]]:
    """Runs of at least two neighbours that are all small; nothing else lies between their numbers."""
    out: list[list[str]] = [[]]
    for name in names:
        if small[name]:
            out[-1].append(name)
        else:
            out.append([])
    return [s for s in out if len(s) > 1]
