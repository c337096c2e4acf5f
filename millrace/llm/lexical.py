"""Ranked lexical search: term at a time, rarest first, with a limit on accumulators.

One pass over the documents keeps, for each, its length and how often it holds the terms of a
block of items. Parts of these postings are then searched where they lie. An item's terms come
rarest first; each adds what it weighs to the partial scores, the accumulators, of the documents
that hold it. As soon as all terms to come can together not reach the k-th partial score, no
document gets a new accumulator; those that have one are still completed exactly. The best of all
parts are merged.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import col, portions
from millrace.llm.infill import flat
from millrace.session import materialise

TOP = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # fixed value, given by the contract
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS_AT_ONCE = 1 << 18  # of all items of a block, about; they are broadcast
POSTINGS_AT_ONCE = 1 << 21  # searched together
BYTES_AT_ONCE = 1 << 22

# Every byte as a term has it; what separates terms becomes a space.
FOLD = np.array([b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)], dtype=np.uint8)
FOLD[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, terms (each once): rows that share an id are one item; an item without terms is left out."""
    found = F.regexp_extract_all(F.translate(col(text), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(col(item_id).alias("item_id"), F.explode(found).alias("term")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n, terms, tfs for every document with a term: its terms among the vocabulary, ascending, and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = max(1, len(vocabulary))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = flat(batch.column(1))
            for part in portions((texts.end - texts.begin).tolist(), BYTES_AT_ONCE):
                words = [FOLD[texts.data[b:e]].tobytes().split() for b, e in zip(texts.begin[part].tolist(), texts.end[part].tolist())]
                n = np.array([len(w) for w in words], dtype=np.int64)
                ids = np.fromiter(map(number, itertools.chain.from_iterable(words), itertools.repeat(-1)), dtype=np.int64, count=int(n.sum()))
                doc = np.repeat(np.arange(len(words)), n)
                found, tfs = np.unique((doc * size + ids)[ids >= 0], return_counts=True)
                bounds = np.searchsorted(found, np.arange(len(words) + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in ((found % size).astype(np.int32), tfs.astype(np.int64))]
                ids_of_docs = batch.column(0).slice(part.start, len(words))
                made = pa.RecordBatch.from_arrays([ids_of_docs, pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])
                yield made.filter(pa.array(n > 0))

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(col(doc_id).alias("doc_id"), col(text)).mapInArrow(read, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_measure(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of every document; the numbers of Python where 64 bits are too few."""
    if int(n.max(initial=0)) * 90 * n_docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)
    return 10 + 90 * n * n_docs // n_terms


@dataclass
class Part:
    """Postings of some documents by term: ``docs[bounds[t] : bounds[t + 1]]`` hold term t, ascending, each adding ``adds``."""

    bounds: np.ndarray
    docs: np.ndarray
    adds: np.ndarray
    most: np.ndarray  # by term
    size: int


def part_of(n: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> Part:
    docs = np.repeat(np.arange(len(n)), counts)
    m = length_measure(n, n_docs, n_terms)
    adds = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs]))
    order = np.argsort(terms, kind="stable")
    docs, adds = docs[order], adds[order]
    bounds = np.searchsorted(terms[order], np.arange(len(weights) + 1))
    most = np.zeros(len(weights), dtype=np.int64)
    held = np.flatnonzero(np.diff(bounds))
    if len(held):
        most[held] = np.maximum.reduceat(adds, bounds[held])
    return Part(bounds, docs, adds, most, len(n))


def scores(part: Part, terms: Sequence[int], top: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents with an accumulator and their scores; all of the ``top`` best that reach ``floor`` are among them.

    ``terms`` come rarest first. A document that has none of the terms so far can get at most the
    sum of what is left; once that is below the k-th partial score, it cannot even tie.
    """
    held = [t for t in terms if part.bounds[t] < part.bounds[t + 1]]
    left = np.cumsum([part.most[t] for t in reversed(held)])[::-1]
    acc = np.zeros(part.size, dtype=np.int64)
    kept: np.ndarray | None = None  # once no more are created
    for i, t in enumerate(held):
        docs, adds = part.docs[part.bounds[t] : part.bounds[t + 1]], part.adds[part.bounds[t] : part.bounds[t + 1]]
        if kept is None:
            least = floor
            if i and part.size >= top:
                least = max(least, int(np.partition(acc, part.size - top)[part.size - top]))
            if left[i] < least:
                kept = np.flatnonzero(acc)
        if kept is None:
            acc[docs] += adds
        elif len(kept) * 16 < len(docs):  # few survivors look themselves up in a long list
            at = np.searchsorted(docs, kept)
            found = at < len(docs)
            found[found] = docs[at[found]] == kept[found]
            acc[kept[found]] += adds[at[found]]
        else:
            alive = acc[docs] > 0
            acc[docs[alive]] += adds[alive]
    kept = np.flatnonzero(acc) if kept is None else kept
    return kept, acc[kept]


def best(docs: np.ndarray, score: np.ndarray, places: np.ndarray, top: int, floor: int) -> np.ndarray:
    """Indices of the ``top`` highest scores from ``floor`` on, equal ones by the place of their document."""
    if len(score) > top:
        floor = max(floor, int(np.partition(score, len(score) - top)[len(score) - top]))
    near = np.flatnonzero((score >= floor) & (score > 0))
    return near[np.lexsort((places[docs[near]], -score[near]))[:top]]


def _search_block(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, top: int) -> DataFrame:
    """Unranked candidates (item_id, doc_id, score) of one block of items: the best of every part."""
    spark = docs.sparkSession
    schema = f"item_id {dict(queries.dtypes)['item_id']}, doc_id {dict(docs.dtypes)[doc_id]}, score long"
    block = queries.select("item_id", "terms").toArrow()  # bounded by TERMS_AT_ONCE
    if not block.num_rows:
        return spark.createDataFrame([], schema)
    lists = block.column("terms").to_pylist()
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in lists for t in terms}))}
    index = materialise(postings(docs, {t.encode(): i for t, i in vocabulary.items()}, doc_id, text), "postings")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, holders in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the block
        df[term] = holders
    weights = np.array([weight(n_docs, int(d)) for d in df], dtype=np.int64)
    asked = [sorted((vocabulary[t] for t in terms if df[vocabulary[t]]), key=lambda t: (df[t], t)) for terms in lists]
    shared = spark.sparkContext.broadcast((block.column("item_id").combine_chunks(), asked, weights))

    def answers(held: list[pa.RecordBatch], floors: np.ndarray, tops: list[np.ndarray]) -> pa.RecordBatch:
        item_ids, asked, weights = shared.value
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, lists = rows.column("doc_id").combine_chunks(), rows.column("terms").combine_chunks()
        n, counts = rows.column("n").to_numpy(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        part = part_of(
            n, counts, lists.flatten().to_numpy(), rows.column("tfs").combine_chunks().flatten().to_numpy(), weights, n_docs, n_terms
        )
        places = np.empty(len(ids), dtype=np.int64)
        places[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        item, doc, score = [], [], []
        for i, terms in enumerate(asked):
            found, points = scores(part, terms, top, int(floors[i]))
            pick = best(found, points, places, top, int(floors[i]))
            tops[i] = np.sort(np.concatenate([tops[i], points[pick]]))[-top:]
            if len(tops[i]) == top:
                floors[i] = tops[i][0]
            item.append(np.full(len(pick), i))
            doc.append(found[pick])
            score.append(points[pick])
        taken = [np.concatenate(v).astype(np.int64) for v in (item, doc, score)]
        return pa.RecordBatch.from_arrays([item_ids.take(pa.array(taken[0])), ids.take(pa.array(taken[1])), pa.array(taken[2])], names=["item_id", "doc_id", "score"])

    def search_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors = np.zeros(len(shared.value[1]), dtype=np.int64)  # k-th score of the task so far
        tops = [np.zeros(0, dtype=np.int64)] * len(floors)
        held, size = [], 0
        for batch in batches:
            values = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
            for part in portions(values.tolist(), POSTINGS_AT_ONCE):
                if held and size + int(values[part].sum()) > POSTINGS_AT_ONCE:
                    yield answers(held, floors, tops)
                    held, size = [], 0
                held.append(batch.slice(part.start, part.stop - part.start))
                size += int(values[part].sum())
        if held:
            yield answers(held, floors, tops)

    return index.mapInArrow(search_parts, schema)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of every item, all rows against all items.

    A null or empty text has no terms: such a document counts nowhere, such an item has no rows. Equal
    scores go by ascending doc_id, nulls last. Repeated rows are documents of their own; item rows that
    share an id are one item. Items are taken in blocks of about ``TERMS_AT_ONCE`` terms, each block with
    a scan of the documents, so what is broadcast does not grow with either table. A task holds
    ``POSTINGS_AT_ONCE`` postings at a time, or those of one document.
    """
    queries = materialise(item_terms(items, item_id, text), "items")
    terms = queries.agg(F.sum(F.size("terms").cast("long"))).first()[0]
    blocks = max(1, -(-(terms or 0) // TERMS_AT_ONCE))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = _search_block(docs, queries.filter(block == b), doc_id, text, top)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
