"""Removal of passages that repeat, by a compressed FM-index per shard.

Every window of ``window`` words has an anchor: the run of ``ANCHOR`` words in it with the
least hash, the leftmost of equals. Equal windows have equal anchors, so the windows around
one anchor, a segment, need to be compared only with segments of the same anchor. Anchors
decide the shard. A shard indexes its distinct segments, each weighted with its number of
occurrences, and reads them as patterns: the matching statistics of backward search tell
from which words a run of ``window`` words occurs twice or more.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm.common import col, portions, unused, words
from millrace.llm.fmindex import FMIndex
from millrace.session import fresh_folder, materialise
from millrace.sources.files import delete

WINDOW = 35  # words; at most 62
ANCHOR = 8  # words
BUSY = 2000  # distinct segments of an anchor beyond which its windows are dealt out one by one
SHARD_WORDS = 1 << 19
CHARACTERS_AT_ONCE = 1 << 20
WORDS_KEPT = 400_000
STEP, OTHER_STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd numbers, the bases of two rolling hashes


class Hashes(dict):
    """64 bits for every word met; a task has its own."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, lists: list[list[bytes]]) -> np.ndarray:
        if len(self) > WORDS_KEPT:
            self.clear()
        return np.fromiter((self[w] for ws in lists for w in ws), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class _Rolling:
    """Hashes of any runs of a sequence, from sums of powers modulo 2**64."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        power = np.full(n, base, dtype=np.uint64)
        back = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        power[:1] = back[:1] = 1
        np.cumprod(power, out=power)
        self.back = np.cumprod(back)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * power, out=self.sums[1:])

    def runs(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        plain = (self.sums[end] - self.sums[first]) * self.back[first]
        return _mix(plain + (end - first).astype(np.uint64))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its least, of equals the first."""
    place, size = np.arange(len(values)), 1

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    while size * 2 <= width:
        place = least(place[: len(place) - size], place[size:])
        size *= 2
    if size < width:
        more = width - size
        place = least(place[: len(place) - more], place[more:])
    return place


def segments(
    lists: list[list[bytes]], hashes: Hashes, window: int = WINDOW, anchor: int = ANCHOR
) -> dict[str, np.ndarray]:
    """The segments of some documents: anchor and segment hash, document, first word and number of windows."""
    lengths = np.array([len(ws) for ws in lists], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    hashed = hashes.of(lists)
    n = len(hashed) - window + 1
    none = np.zeros(0, dtype=np.int64)
    if n < 1:
        return {"anchor": none.view(np.uint64), "segment": none.view(np.uint64), "doc": none, "first": none, "windows": none}
    doc = np.repeat(np.arange(len(lists)), lengths)
    rolling, other = _Rolling(hashed, STEP), _Rolling(hashed, OTHER_STEP)
    at = np.arange(len(hashed) - anchor + 1)
    grams = rolling.runs(at, at + anchor)
    least = _leftmost_least(grams, window - anchor + 1)[:n]
    whole = np.flatnonzero(doc[:n] == doc[window - 1 :])  # windows inside one document
    if not len(whole):
        return {"anchor": none.view(np.uint64), "segment": none.view(np.uint64), "doc": none, "first": none, "windows": none}
    mine = least[whole]
    fresh = np.r_[True, (mine[1:] != mine[:-1]) | (whole[1:] != whole[:-1] + 1)]
    heads = np.flatnonzero(fresh)
    first, windows = whole[heads], np.diff(np.r_[heads, len(whole)])
    return {
        "anchor": grams[mine[heads]],
        "segment": other.runs(first, first + windows + window - 1),
        "doc": doc[first],
        "first": first - starts[doc[first]],
        "windows": windows,
    }


SEGMENT = StructType([StructField(c, LongType()) for c in ("anchor", "segment", "h1", "h2", "first", "windows")])


def _document_keys() -> list[Column]:
    """128 bits that stand for doc_id and text, never NULL."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64("doc_id", text).alias("h1"), F.xxhash64(F.lit(1), text, "doc_id").alias("h2")]


def _find_segments(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            for part in portions([len(t or "") for t in texts], CHARACTERS_AT_ONCE):
                got = segments([words(t) for t in texts[part]], hashes, window)
                doc = got.pop("doc")
                columns = {"h1": h1[part][doc], "h2": h2[part][doc], "first": got["first"], "windows": got["windows"]}
                columns |= {c: got[c].view(np.int64) for c in ("anchor", "segment")}
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in SEGMENT.names})

    return find


PIECE = StructType(
    [StructField(c, LongType()) for c in ("anchor", "segment", "weight", "of_anchor", "of_segment", "place")]
    + [StructField("words", StringType())]
)


def _find_pieces(window: int):
    """The words of the wanted segments of each document; of a busy anchor, of each window by itself."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            texts, wanted = batch.column("text").to_pylist(), batch.column("wanted")
            for part in portions([len(t or "") for t in texts], CHARACTERS_AT_ONCE):
                rows = []
                for k in range(part.start, part.stop):
                    ws = words(texts[k])
                    for s in wanted[k].as_py():
                        end = s["first"] + s["windows"] + window - 1
                        if s["busy"]:
                            own = ws[s["first"] : end]
                            hashed = hashes.of([own])
                            at = np.arange(s["windows"])
                            a, b = (_Rolling(hashed, base).runs(at, at + window).view(np.int64) for base in (STEP, OTHER_STEP))
                            for i in at.tolist():
                                text = b" ".join(own[i : i + window])
                                rows.append((int(a[i]), int(b[i]), s["weight"], s["anchor"], s["segment"], i, text))
                        else:
                            text = b" ".join(ws[s["first"] : end])
                            rows.append((s["anchor"], s["segment"], s["weight"], s["anchor"], s["segment"], -1, text))
                columns = list(zip(*rows)) or [[]] * len(PIECE.names)
                arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array([x.decode("utf-8", "replace") for x in columns[-1]], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=PIECE.names)

    return find


def _search_shard(window: int):
    def search(shard: pa.Table) -> pa.Table:
        """The windows of each piece of a shard that occur twice or more, as bits."""
        symbol: dict[bytes, int] = {}
        pieces = [[symbol.setdefault(w, len(symbol) + 1) for w in words(t)] for t in shard["words"].to_pylist()]
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        text = np.fromiter((s for p in pieces for s in (*p, 0)), dtype=np.int64, count=int(length.sum()) + len(pieces))
        start = np.cumsum(length + 1) - (length + 1)
        index = FMIndex(text, np.repeat(shard["weight"].to_numpy(), length + 1))
        hits = index.matching(start, length, window)
        kept = np.flatnonzero(hits)
        return shard.select(["anchor", "segment"]).take(pa.array(kept)).append_column("hits", pa.array(hits[kept], pa.int64()))

    return search


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now instead of at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """h1, h2 (the document), first, hits: bit i says that the window at word ``first + i`` starts
    elsewhere too, in this document or another."""
    spark = docs.sparkSession
    texts = docs.select(*_document_keys(), "text")
    folder = fresh_folder(spark, "segments")
    texts.mapInArrow(_find_segments(window), SEGMENT).write.parquet(folder)
    stored = spark.read.schema(SEGMENT).parquet(folder)
    # an anchor that occurs once has no partner
    shared = stored.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    occurrences = materialise(stored.join(materialise(shared, "anchors"), "anchor", "left_semi"), "occurrences")
    delete(spark, folder)
    del stored, shared
    _release(spark)

    # equal segments are one piece with a weight; any of them can lend its words
    lend = [F.first(c).alias(c) for c in ("h1", "h2", "first", "windows")]
    distinct = materialise(occurrences.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("weight"), *lend), "distinct")
    # few, and written, so that their size is known and the segments need not be shuffled to meet them
    busy = materialise(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUSY), "busy")
    marked = distinct.join(busy.select("anchor", F.lit(True).alias("busy")), "anchor", "left")
    wanted = F.struct("anchor", "segment", "weight", "first", "windows", F.coalesce("busy", F.lit(False)).alias("busy"))
    per_document = marked.groupBy("h1", "h2").agg(F.collect_list(wanted).alias("wanted"))
    pieces = materialise(texts.join(per_document, ["h1", "h2"]).select("text", "wanted").mapInArrow(_find_pieces(window), PIECE), "pieces")
    _release(spark)

    plain = pieces.filter("place < 0").dropDuplicates(["anchor", "segment"]).select("anchor", "segment", "weight", "words")
    single = pieces.filter("place >= 0").dropDuplicates(["of_anchor", "of_segment", "place"])
    alone = single.groupBy("anchor", "segment").agg(F.sum("weight").alias("weight"), F.first("words").alias("words"))
    size = distinct.agg(F.sum(F.col("windows") + (window - 1))).first()[0] or 0
    shards = max(1, -(-size // SHARD_WORDS))
    # windows overlap, so together they have many times the words of their segments
    windows = pieces.filter("place >= 0").select("anchor", "segment").distinct().count()
    window_shards = max(1, -(-windows * window // SHARD_WORDS))
    # a segment and a window may have equal hashes, but never equal words: windows have shards of their own
    dealt = plain.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).unionByName(
        alone.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(window_shards)) + shards)
    )
    result = StructType([*SEGMENT.fields[:2], StructField("hits", LongType()), StructField("shard", LongType())])

    def search(shard: pa.Table) -> pa.Table:
        hits = _search_shard(window)(shard)
        return hits.append_column("shard", pa.array([shard["shard"][0].as_py()] * len(hits), pa.int64()))

    hits = materialise(dealt.groupBy("shard").applyInArrow(search, result), "hits")
    of_plain = hits.filter(F.col("shard") < shards).select("anchor", "segment", "hits")
    of_single = (
        single.select("anchor", "segment", "of_anchor", "of_segment", "place")
        .join(hits.filter(F.col("shard") >= shards).select("anchor", "segment"), ["anchor", "segment"])
        .groupBy(F.col("of_anchor").alias("anchor"), F.col("of_segment").alias("segment"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place as int))")).alias("hits"))
    )
    both = of_plain.unionByName(of_single)
    return materialise(occurrences.join(both, ["anchor", "segment"]).select("h1", "h2", "first", "hits"), "repeated")


def kept_words(text: str | None, spots: list[dict] | None, window: int) -> tuple[list[bytes], int]:
    """The words that no repeated window covers, and how many are covered."""
    ws = words(text)
    if spots is None or not len(spots):
        return ws, 0
    change = np.zeros(len(ws) + 1, dtype=np.int64)
    for s in spots:
        bits = s["hits"]
        while bits:
            low = bits & -bits
            first = s["first"] + low.bit_length() - 1
            change[first] += 1
            change[first + window] -= 1
            bits ^= low
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(ws, keep.tolist()) if k], len(ws) - int(keep.sum())


def _with_spots(docs: DataFrame, name: str, window: int) -> DataFrame:
    """The documents with all columns and their repeated windows in ``name``."""
    spots = repeated_windows(docs.select("doc_id", "text"), window)
    spots = spots.groupBy(F.col("h1").alias("s1"), F.col("h2").alias("s2")).agg(F.collect_set(F.struct("first", "hits")).alias(name))
    own = [c.alias(unused(docs, n)) for c, n in zip(_document_keys(), ("h1", "h2"))]
    h1, h2 = (unused(docs, n) for n in ("h1", "h2"))
    _release(docs.sparkSession)
    keyed = docs.select("*", *own)
    return keyed.join(spots, (col(h1) == F.col("s1")) & (col(h2) == F.col("s2")), "left").select(*[col(c) for c in docs.columns], name)


COUNTS = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    Words that a window covers are removed if the window's words also start anywhere else;
    all windows are those of the input. A null or empty text has no words, a text shorter
    than a window loses none. Repeated rows are other documents, so they repeat each other.
    Other columns are left out.
    """

    @F.pandas_udf(COUNTS)
    def count(texts: pd.Series, spots: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, spots):
            kept, removed = kept_words(text, found, window)
            rows.append((len(kept) + removed, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=COUNTS.names)

    rows = _with_spots(docs.select("doc_id", "text"), "spots", window)
    return rows.select("doc_id", count("text", "spots").alias("c")).select("doc_id", "c.*")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns. Where words are removed, the text is the kept words
    joined by one space, and ``n_chars``, where there is such a column, counts it; other texts stay as they are."""
    name = unused(docs, "spots")

    @F.pandas_udf(StringType())
    def keep(texts: pd.Series, spots: pd.Series) -> pd.Series:
        kept = (kept_words(t, s, window)[0] for t, s in zip(texts, spots))
        return pd.Series([b" ".join(k).decode("utf-8", "replace") for k in kept], dtype=object)

    rows = _with_spots(docs, name, window)
    touched = F.when(col(name).isNotNull(), keep("text", col(name))).otherwise(F.col("text"))
    rows = rows.withColumn("text", touched)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(col(name).isNotNull(), length).otherwise(F.col("n_chars")))
    return rows.select(*[col(c) for c in docs.columns])
