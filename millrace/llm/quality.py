"""Quality of a text by a byte-level convolutional network in numpy.

Learned filters run over the bytes of the whole text, cut into chunks that overlap by the
width of a filter less one. Each chunk keeps the maximum of every filter; the maxima and
means over all chunks go into one logistic output.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from millrace.llm.common import portions, within

FILTERS, WIDTH, CHUNK = 16, 6, 256
SAMPLE = 3000  # labelled rows that the network is trained on, at most
SAMPLE_BYTES = 1 << 15  # of a drawn text on average, at most; every text is scored whole
EPOCHS, STEPS, BATCH, RATE, SEED = (6, 14), 560, 32, 0.02, 7  # as many epochs as give so many steps, within bounds
BYTES_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 64
THRESHOLD = 0.3


@dataclass
class Network:
    """``taps[j, byte]`` is what the byte at place j of a window adds to each filter."""

    taps: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # for maxima, then for means over the chunks
    offset: float


def chunks(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts as rows of CHUNK + WIDTH - 1 bytes, and how many each text has.

    Texts are padded with zero bytes to whole chunks; an empty or null text is one chunk.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    counts = np.array([max(1, -(-len(b) // CHUNK)) for b in raw], dtype=np.int64)
    flat = np.zeros(int(counts.sum()) * CHUNK, dtype=np.uint8)
    for at, b in zip((np.cumsum(counts) - counts) * CHUNK, raw):
        flat[at : at + len(b)] = np.frombuffer(b, dtype=np.uint8)
    rows = np.zeros((len(flat) // CHUNK, CHUNK + WIDTH - 1), dtype=np.uint8)
    rows[:, :CHUNK] = flat.reshape(-1, CHUNK)
    same = np.ones(len(rows), dtype=bool)  # the next chunk belongs to the same text
    same[np.cumsum(counts) - 1] = False
    rows[same, CHUNK:] = rows[np.flatnonzero(same) + 1, : WIDTH - 1]
    return rows, counts


def pooled(network: Network, rows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The maximum of every filter in every chunk, not below zero, and on demand where it is."""
    # two taps at a time: a table over pairs of symbols
    first, second, symbols = network.taps[0::2], network.taps[1::2], network.taps.shape[1]
    tables = [(a[:, None, :] + b[None, :, :]).reshape(symbols * symbols, -1) for a, b in zip(first, second)]
    best = np.empty((len(rows), network.bias.shape[0]), dtype=np.float32)
    where = np.empty(best.shape, dtype=np.int64) if places else None
    for i in range(0, len(rows), ROWS_AT_ONCE):
        part = rows[i : i + ROWS_AT_ONCE].astype(np.intp)
        pair = part[:, :-1] * symbols + part[:, 1:]
        total = tables[0].take(pair[:, :CHUNK], axis=0)
        for k in range(1, len(tables)):
            total += tables[k].take(pair[:, 2 * k : 2 * k + CHUNK], axis=0)
        best[i : i + ROWS_AT_ONCE] = total.max(axis=1)
        if places:
            where[i : i + ROWS_AT_ONCE] = total.argmax(axis=1)
    return np.maximum(best + network.bias, 0), where


def combine(best: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Maxima and means over the chunks of each text."""
    heads = np.cumsum(counts) - counts
    return np.concatenate(
        [np.maximum.reduceat(best, heads, axis=0), np.add.reduceat(best, heads, axis=0) / counts[:, None]], axis=1
    )


def probability(network: Network, texts: Sequence[str | None]) -> np.ndarray:
    """The probability of label 1 for every text."""
    out = []
    for part in portions([len(t or "") for t in texts], BYTES_AT_ONCE):
        rows, counts = chunks(texts[part])
        features = combine(pooled(network, rows)[0], counts)
        out.append(1 / (1 + np.exp(-np.clip(features @ network.weights + network.offset, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def train(texts: Sequence[str], labels: Sequence[int], epochs: int | None = None, seed: int = SEED) -> Network:
    """Stochastic gradient descent (Adam) on the log loss, both labels with equal weight.

    Only the window that gave a maximum gets its gradient, so a step touches few taps. Bytes that
    occur nowhere in the texts keep the taps they start with; the others are numbered densely, so that
    tables and gradients have no more rows than the texts have different bytes.
    """
    rng = np.random.default_rng(seed)
    network = Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        rng.normal(0, 0.3, 2 * FILTERS),
        0.0,
    )
    label = np.asarray(labels, dtype=np.float64)
    share = label.mean() if len(label) else 1.0
    if len(label) == 0 or share in (0.0, 1.0):
        network.weights[:] = 0
        network.offset = 4.0 if share else -4.0
        return network
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    if epochs is None:
        epochs = min(EPOCHS[1], max(EPOCHS[0], STEPS // -(-len(texts) // BATCH)))
    data = [chunks([t]) for t in texts]
    used = np.flatnonzero(np.sum([np.bincount(rows.ravel(), minlength=256) for rows, _ in data], axis=0))
    symbol = np.zeros(256, dtype=np.uint8)
    symbol[used] = np.arange(len(used))
    data = [(symbol[rows], counts) for rows, counts in data]
    dense = Network(np.ascontiguousarray(network.taps[:, used]), network.bias, network.weights, 0.0)
    _descend(dense, data, label, weight, epochs, rng)
    network.taps[:, used] = dense.taps
    # the weights made both labels alike in number: put the real share back
    network.offset = dense.offset + float(np.log(share / (1 - share)))
    return network


def _descend(
    network: Network, data: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, weight: np.ndarray, epochs: int, rng: np.random.Generator
) -> None:
    """Train the network in place."""
    symbols = network.taps.shape[1]
    params = [network.taps, network.bias, network.weights]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    beta, gamma, step = 0.9, 0.99, 0
    for epoch in range(epochs):
        rate = RATE * (0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 0.05)
        order = rng.permutation(len(data))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            rows = np.concatenate([data[k][0] for k in pick])
            counts = np.concatenate([data[k][1] for k in pick])
            best, where = pooled(network, rows, places=True)
            features = combine(best, counts)
            p = 1 / (1 + np.exp(-np.clip(features @ network.weights + network.offset, -30, 30)))
            delta = (p - label[pick]) * weight[pick] / len(pick)
            # back through maxima and means to chunks
            text = np.repeat(np.arange(len(pick)), counts)
            top = best == features[text, :FILTERS]
            ways = np.add.reduceat(top, np.cumsum(counts) - counts, axis=0)[text]
            back = delta[text, None] * (
                network.weights[:FILTERS] * top / ways + network.weights[FILTERS:] / counts[text, None]
            )
            back = (back * (best > 0)).astype(np.float32)
            lane = np.broadcast_to(np.arange(FILTERS), where.shape)
            places = np.stack([np.take_along_axis(rows, where + j, axis=1) for j in range(WIDTH)]).astype(np.int64)
            places += symbols * np.arange(WIDTH)[:, None, None]
            flat = (places * FILTERS + lane).ravel()
            grad = np.bincount(flat, weights=np.tile(back.ravel(), WIDTH), minlength=network.taps.size)
            grad = grad.reshape(network.taps.shape).astype(np.float32)
            step += 1
            for p_, g, (m, v) in zip(params, (grad, back.sum(axis=0), features.T @ delta + 1e-4 * network.weights), moments):
                m += (1 - beta) * (g - m)
                v += (1 - gamma) * (g * g - v)
                p_ -= (rate * (m / (1 - beta**step)) / (np.sqrt(v / (1 - gamma**step)) + 1e-7)).astype(p_.dtype)
            network.offset -= rate * float(delta.sum()) * 10


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, most: int = SAMPLE) -> pd.DataFrame:
    """text, quality of up to ``most`` labelled documents that ``learn`` (on doc_id) admits, by a hash of the id.

    Labels without a document are nothing to draw from, however many they are. The drawn ones have up to
    ``most * SAMPLE_BYTES`` bytes together: a document that no longer fits is passed over. Of several
    texts of a doc_id the shortest is drawn.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    sized = texts.filter(learn).select("doc_id", F.struct(F.octet_length("text").alias("size"), "text_key").alias("least"))
    sized = sized.groupBy("doc_id").agg(F.min("least").alias("least"))
    drawn = sized.join(known, "doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most)
    found = drawn.collect()  # bounded by ``most``
    fits = within([r.least["size"] for r in found], most * SAMPLE_BYTES)
    schema = StructType([texts.schema["doc_id"], StructField("text_key", LongType()), known.schema["quality"]])
    taken = [(r.doc_id, r.least.text_key, r.quality) for r, fit in zip(found, fits) if fit]
    chosen = docs.sparkSession.createDataFrame(taken, schema)
    rows = texts.join(F.broadcast(chosen), ["doc_id", "text_key"]).groupBy("doc_id", "quality").agg(F.first("text").alias("text"))
    return rows.toPandas().sort_values("doc_id")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from; a null doc_id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame) -> Network:
    sample = labelled_sample(docs, labels, ~held_out())
    return train(sample["text"].tolist(), sample["quality"].tolist())


def scorer(docs: DataFrame, network: Network):
    """A column function: text to probability."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # 100 KB

    @F.pandas_udf(DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(probability(shared.value, part.tolist()))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    The network learns from labelled rows with crc32(doc_id) mod 5 other than 0, at most
    ``SAMPLE`` of them; without any, or with one label alone, the score is a constant. A
    null or empty text is scored as one chunk of zero bytes. Repeated rows get equal
    scores; other columns are left out.
    """
    score = scorer(docs, learned(docs, labels))
    scored = docs.select("doc_id", held_out().alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the network does not reject, with all their columns."""
    return docs.filter(scorer(docs, learned(docs, labels))("text") >= threshold)
