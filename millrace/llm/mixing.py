"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are handed out in blocks of equal size. Sources get blocks by highest quotients of
their targets, the shards of a source get its blocks by highest quotients of their words,
and inside a shard a seeded order picks the blocks.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.common import WORD, col, copy_number, row_key, unused, words
from millrace.session import materialise

BLOCK = 64  # words
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 16
TIMES = 2  # how often a word may be taken


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Mapping[object, int], weights: Mapping[object, float], total: float, most: float = TIMES) -> dict:
    """The total shared by weight; none above ``most`` times its size, the excess reshared."""
    left, open_, out = float(total), {s for s in sizes}, {}
    while open_:
        weight = sum(weights[s] for s in open_)
        above = [s for s in open_ if left * weights[s] / weight > most * sizes[s]]
        if not above:
            return out | {s: left * weights[s] / weight for s in open_}
        for s in above:
            out[s] = float(most * sizes[s])
            open_.remove(s)
        left = max(0.0, total - sum(out.values()))
    return out


def apportion(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Lague: seat after seat to the highest quotient ``vote / (2 * seats + 1)``.

    Rounding an even share is already such an apportionment of its own total, so only the
    difference, at most half a seat each, goes one by one. No party gets more than
    ``most``; ties go to the first.
    """
    seats = min(seats, sum(m for v, m in zip(votes, most) if v > 0))
    got = [0] * len(votes)
    open_ = [i for i, v in enumerate(votes) if v > 0 and most[i] > 0]
    left = seats
    while open_ and left > 0:  # parties that are full leave the even share to the others
        even = left / sum(votes[i] for i in open_)
        full = {i for i in open_ if math.floor(votes[i] * even + 0.5) >= most[i]}
        if not full:
            for i in open_:
                got[i] = math.floor(votes[i] * even + 0.5)
            break
        for i in full:
            got[i] = most[i]
            left -= most[i]
        open_ = [i for i in open_ if i not in full]
    short = seats - sum(got)
    if short > 0:
        heap = [(-v / (2 * got[i] + 1), i) for i, v in enumerate(votes) if v > 0 and got[i] < most[i]]
        heapq.heapify(heap)
        for _ in range(short):
            _, i = heapq.heappop(heap)
            got[i] += 1
            if got[i] < most[i]:
                heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    elif short < 0:
        heap = [(votes[i] / (2 * got[i] - 1), -i) for i in range(len(votes)) if got[i] > 0]
        heapq.heapify(heap)
        for _ in range(-short):
            _, i = heapq.heappop(heap)
            i = -i
            got[i] -= 1
            if got[i] > 0:
                heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    return got


def _picked(total: int, wanted: int, block: int, seed: str) -> np.ndarray:
    """Words taken from each block when ``wanted`` of ``total`` words are taken in the seeded order."""
    n = -(-total // block)
    sizes = np.full(n, block, dtype=np.int64)
    if n:
        sizes[-1] = total - (n - 1) * block
    order = sorted(range(n), key=lambda b: hashlib.md5(f"{seed}/{b}".encode()).digest())
    before = np.r_[0, np.cumsum(sizes[order])]
    taken = np.zeros(n, dtype=np.int64)
    taken[order] = np.clip(wanted - before[:-1], 0, sizes[order])
    return taken


def _select(shard: pa.Table, block: int, seed: str) -> tuple[np.ndarray, np.ndarray, int, list[list[int]]]:
    """What the documents of a shard give. They stand in a seeded row, which is cut into blocks.

    Returns their order in the table, the words taken from each, the passes over the whole
    shard, and what is taken once more: the positions of its words as first, end, first, end.
    """
    order = np.lexsort([shard[c].to_numpy().astype(str) for c in ("key", "order")])
    size = shard["size"].to_numpy()[order]
    end = np.cumsum(size)
    start = end - size
    total, quota = int(size.sum()), shard["quota"][0].as_py()
    passes, rest = divmod(quota, total) if total else (0, 0)
    per_block = _picked(total, rest, block, f"{seed}/{shard['number'][0]}/{shard['shard'][0]}")
    begin = np.flatnonzero(per_block) * block
    stop = begin + per_block[per_block > 0]
    if len(begin):  # neighbours are one stretch
        apart = begin[1:] != stop[:-1]
        begin, stop = begin[np.r_[True, apart]], stop[np.r_[apart, True]]
    first = np.searchsorted(stop, start, side="right")
    last = np.searchsorted(begin, end, side="left")
    stretches, taken = [], passes * size
    for k in np.flatnonzero((last > first) & (size > 0)):
        pairs = np.stack([np.maximum(begin[first[k] : last[k]], start[k]), np.minimum(stop[first[k] : last[k]], end[k])], 1)
        taken[k] += int((pairs[:, 1] - pairs[:, 0]).sum())
        stretches.append((k, (pairs - start[k]).ravel().tolist()))
    more: list[list[int]] = [[] for _ in size]
    for k, pairs in stretches:
        more[k] = pairs
    return order, taken, passes, more


def _with_quotas(docs: DataFrame, weights: Sequence[float], share: float, block: int, seed: str) -> DataFrame:
    """A narrow row for every document: its key and size, its source's numbers, its shard, and the
    words the shard is to give. Texts are read, not kept."""
    spark = docs.sparkSession
    sized = materialise(
        docs.select(
            "doc_id",
            "source",
            word_count("text").alias("size"),
            row_key("source").alias("key"),
        ).withColumn("order", F.md5(F.concat_ws("/", F.lit(seed), "key"))),
        "sizes",
        few_files=True,
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    ordered = sorted(per_source, key=lambda r: (r.source is None, (r.source or "").encode("utf-8")))
    size = {i: r.words for i, r in enumerate(ordered)}
    wanted = targets(size, {i: weights[i % len(weights)] for i in size}, share * sum(size.values()))
    votes = [wanted[i] for i in size]
    blocks = apportion(votes, round(sum(votes) / block), [-(-TIMES * size[i] // block) for i in size])
    plan = []
    for i, r in enumerate(ordered):
        shards = max(1, -(-r.words // SHARD_WORDS), -(-r.rows // SHARD_ROWS))
        plan.append((r.source, i, int(r.words), float(wanted[i]), blocks[i], int(shards)))
    schema = "source string, number int, source_size long, target double, blocks long, shards int"
    sources = F.broadcast(spark.createDataFrame(plan, schema)).alias("s")  # one row per source
    joined = sized.alias("d").join(sources, F.col("d.source").eqNullSafe(F.col("s.source")))
    shard = (F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards")).cast("int")
    placed = joined.select("doc_id", "size", "order", "key", "number", "source_size", "target", "blocks", shard.alias("shard"))

    def quotas(cells: pd.DataFrame) -> pd.DataFrame:
        """The blocks of one source, by the words of its shards."""
        cells = cells.sort_values("shard")
        total = cells["words"].tolist()
        got = apportion(total, int(cells["blocks"].iloc[0]), [-(-TIMES * t // block) for t in total])
        cells["quota"] = [min(g * block, TIMES * t) for g, t in zip(got, total)]
        return cells[["number", "shard", "quota"]]

    cells = placed.groupBy("number", "shard", "blocks").agg(F.sum("size").alias("words"))
    cells = cells.groupBy("number").applyInPandas(quotas, "number int, shard int, quota long")
    return placed.drop("blocks").join(cells, ["number", "shard"])


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, block: int = BLOCK, seed: str = "mix"
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of the document in the mix) for every row.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share``
    of all words; no word is taken more than twice. The words taken from a source are its
    blocks times the block size. A null or empty text has size 0 and gives nothing; repeated
    rows are documents of their own; other columns are left out. Reruns agree.

    The driver sees one row per source. A shard holds about a million words or 65,536 rows,
    so a source with a third of all rows is many shards. Rows are dealt by doc_id and text together,
    so those of one doc_id, or of none, lie in different shards unless they are alike in both.
    """
    rows = _with_quotas(docs, weights, share, block, seed)
    kept = ["doc_id", "size", "source_size", "target"]

    def select(shard: pa.Table) -> pa.Table:
        order, taken, _, _ = _select(shard, block, seed)
        return shard.select(kept).take(pa.array(order)).append_column("taken", pa.array(taken, pa.int64()))

    fields = StructType([rows.schema[c] for c in kept]).add("taken", "long")
    return rows.groupBy("number", "shard").applyInArrow(select, fields)


@F.pandas_udf(StringType())
def cut(texts: pd.Series, stretches: pd.Series) -> pd.Series:
    """The words of a text at first, end, first, end ..., joined by one space."""
    out = []
    for text, pairs in zip(texts, stretches):
        w = words(text)
        out.append(b" ".join(x for a, b in zip(pairs[::2], pairs[1::2]) for x in w[a:b]).decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, block: int = BLOCK, seed: str = "mix"
) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document that is taken whole comes as it is, once for each time; a document of which
    some words are taken comes with these words, joined by one space, and ``n_chars``, where
    there is such a column, counts them. Otherwise like ``mix``. What is taken is decided on
    narrow rows and meets the texts by a key, which shuffles them once.
    """
    rows = _with_quotas(docs, weights, share, block, seed)
    fields = StructType([rows.schema["key"], StructField("passes", IntegerType()), StructField("stretches", ArrayType(LongType()))])

    def select(shard: pa.Table) -> pa.Table:
        order, _, passes, more = _select(shard, block, seed)
        size = shard["size"].to_numpy()[order].tolist()
        whole = [passes * (n > 0) + (m == [0, n]) for n, m in zip(size, more)]
        part = [[] if m == [0, n] else m for n, m in zip(size, more)]
        chosen = shard.select(["key"]).take(pa.array(order))
        chosen = chosen.append_column("passes", pa.array(whole, pa.int32()))
        return chosen.append_column("stretches", pa.array(part, pa.list_(pa.int64())))

    chosen = rows.groupBy("number", "shard").applyInArrow(select, fields).filter((F.col("passes") > 0) | (F.size("stretches") > 0))
    # rows that are alike share a key; which of them gets which part makes no difference
    chosen = chosen.groupBy("key").agg(F.collect_list(F.struct("passes", "stretches")).alias("parts"))
    key, parts, n, text = (unused(docs, c) for c in ("_key", "_parts", "_n", "_text"))
    numbered = docs.withColumn(key, row_key("source")).withColumn(n, copy_number(docs, key))
    joined = numbered.join(chosen.select(F.col("key").alias(key), F.col("parts").alias(parts)), key)
    own = F.get(col(parts), col(n) - 1)
    joined = joined.withColumn(parts, own).filter(col(parts).isNotNull())
    some = F.when(F.size(col(parts)["stretches"]) > 0, F.array(cut("text", col(parts)["stretches"])))
    whole = F.array_repeat(F.lit(None).cast("string"), col(parts)["passes"])
    taken = joined.withColumn(text, F.explode(F.concat(whole, F.coalesce(some, F.array().cast("array<string>")))))
    new = {"text": F.coalesce(col(text), F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length(col(text)).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(col(text).isNotNull(), length).otherwise(F.col("n_chars"))
    return taken.select(*[new.get(c, col(c)).alias(c) for c in docs.columns])
