"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into equal parts that few
neighbours cross. A small network learns the parts of a vector's neighbours. It then
places every vector in its most probable part and routes a query to several, where all
vectors are compared with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from millrace.session import materialise

TOP = 20
SAMPLE = 8192  # vectors the parts are learned from, at most
PER_PART = 32  # sampled vectors in a part, at least
NEIGHBOURS = 12
HIDDEN, EPOCHS, BATCH, RATE, SEED = 128, 40, 256, 0.003, 11
TRIALS, WANTED = 512, 0.95  # queries nothing is learned from, a tenth of the sample at most, and the recall they must reach
SPARE = 1  # parts searched beyond what the trials ask for
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024


def usable(vector: Column) -> Column:
    """Not NULL, not empty, every component finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """For each row the ``k`` other rows with the largest inner product, in blocks."""
    found = np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 1024):
        score = x[i : i + 1024] @ x.T
        score[np.arange(len(score)), np.arange(i, i + len(score))] = -np.inf
        found[i : i + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return found


def _halve(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """True for one half of the nodes; edges (a, b) count in both directions.

    The second eigenvector of the random walk on the graph gives an order, its median a
    cut; then pairs of nodes change sides as long as that takes edges off the cut.
    """
    place = np.full(int(nodes.max()) + 1, -1)
    place[nodes] = np.arange(len(nodes))
    inside = (a < len(place)) & (b < len(place))
    u, v = place[a[inside]], place[b[inside]]
    both = (u >= 0) & (v >= 0)
    u, v = u[both], v[both]
    n = len(nodes)
    degree = np.bincount(u, minlength=n) + np.bincount(v, minlength=n) + 1e-9
    centred = x[nodes] - x[nodes].mean(axis=0)
    f = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1] + 1e-6 * rng.normal(size=n)
    for _ in range(60):
        f = f - (f * degree).sum() / degree.sum()
        walked = np.bincount(u, f[v], n) + np.bincount(v, f[u], n)
        f = 0.5 * f + 0.5 * walked / degree
        f /= np.abs(f).max() + 1e-12
    side = np.zeros(n, dtype=bool)
    side[np.argsort(f, kind="stable")[n // 2 :]] = True
    for _ in range(8):
        s = np.where(side, 1.0, -1.0)
        gain = -s * (np.bincount(u, s[v], n) + np.bincount(v, s[u], n))  # edges off the cut if it moves
        here, there = np.flatnonzero(side), np.flatnonzero(~side)
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        m = min(len(here), len(there))
        better = int(((gain[here[:m]] + gain[there[:m]]) > 0).sum()) // 2
        if not better:
            break
        side[here[:better]], side[there[:better]] = False, True
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = SEED) -> np.ndarray:
    """The part of each row: the graph is halved until there are ``parts``, a power of two."""
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    part = np.zeros(len(x), dtype=np.int64)
    for _ in range(parts.bit_length() - 1):
        finer = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            if len(nodes) > 1:
                finer[nodes] += _halve(nodes, a, b, x, rng)
        part = finer
    return part


@dataclass
class Router:
    """One hidden layer; probabilities of the parts for vectors of any length."""

    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    offset: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
        return np.maximum(unit @ self.first + self.bias, 0) @ self.second + self.offset

    def parts(self, x: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each vector, best first; ties to the smaller."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :count]


def train(x: np.ndarray, target: np.ndarray, seed: int = SEED) -> Router:
    """Cross entropy against the shares of the parts among each vector's neighbours."""
    rng = np.random.default_rng(seed)
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    d, parts = x.shape[1], target.shape[1]
    net = [rng.normal(0, np.sqrt(2.0), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (0.05 + 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS)))
        order = rng.permutation(len(x))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            h = np.maximum(unit[rows] @ net[0] + net[1], 0)
            z = h @ net[2] + net[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            delta = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (delta @ net[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((unit[rows].T @ back, back.sum(axis=0), h.T @ delta, delta.sum(axis=0))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Router(*net)


def fit(x: np.ndarray, parts: int, top: int = TOP) -> Router:
    """Parts, router and the number of parts to search as far as the sample tells; ``measure`` tells it of all vectors."""
    if len(x) < 2 * PER_PART or parts < 2:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbours(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] += 2
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
    router = train(x, target / target.sum(axis=1, keepdims=True))
    placed = router.parts(x, 1)[:, 0]
    trial = np.random.default_rng(SEED).permutation(len(x))[:TRIALS]
    near = neighbours_of(x, trial, min(top, len(x) - 1))
    ranked = router.parts(x[trial], parts)
    # the place of each neighbour's part in the query's ranking
    place = np.argmax(ranked[:, None, :] == placed[near][:, :, None], axis=2)
    for probes in range(1, parts + 1):
        if (place < probes).mean() >= WANTED:
            break
    router.probes = min(parts, probes + SPARE)
    return router


def measure(rows: DataFrame, router: Router, ids: np.ndarray, trials: np.ndarray, top: int) -> int:
    """The number of parts to search, by the true neighbours of the trial queries among all vectors.

    One pass over the vectors; of each task the ``top`` of each trial query are shuffled.
    """
    parts, d = len(router.offset), trials.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((router, ids, trials))  # TRIALS vectors

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, asking, queries = shared.value
        best = None
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=np.float64).reshape(-1, d)
            there = nearest(asking, queries, batch["vec_id"].to_numpy(np.int64), x, top)
            part = pd.Series(model.parts(x, 1)[:, 0].astype(np.int32), index=batch["vec_id"].to_numpy(np.int64))
            there["part"] = part.reindex(there["vec_id"]).to_numpy(np.int32)
            best = there if best is None else pd.concat([best, there])
            best = best.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(top)
        if best is not None:
            yield best

    found = rows.select("vec_id", "x").mapInPandas(compare, "query_id long, vec_id long, score double, part int")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    near = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "part").toPandas()
    ranked = pd.Series(list(router.parts(trials, parts)), index=ids)
    place = np.array([int(np.argmax(ranked[q] == p)) for q, p in zip(near["query_id"], near["part"])])
    for probes in range(1, parts + 1):
        if (place < probes).mean() >= WANTED:
            break
    return min(parts, probes + SPARE)


def neighbours_of(x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    score = x[rows] @ x.T
    score[np.arange(len(rows)), rows] = -np.inf
    return np.argpartition(-score, k - 1, axis=1)[:, :k]


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, top: int) -> pd.DataFrame:
    """The ``top`` nearest of each query among the vectors, its own id excepted.

    A matrix product finds the candidates; their scores are then summed one by one in the
    same way everywhere, so that equal vectors have equal scores.
    """
    out = []
    product = queries @ vectors.T
    slack = 1e-9 * np.maximum(np.abs(product).max(axis=1, initial=0), 1e-300)
    product[query_ids[:, None] == ids[None, :]] = -np.inf
    for k in range(len(query_ids)):
        row = product[k]
        n = min(top, int((row > -np.inf).sum()))
        if n:
            least = np.partition(row, len(row) - n)[len(row) - n]
            near = np.flatnonzero(row >= least - slack[k])
            score = (vectors[near] * queries[k]).sum(axis=1)
            best = np.lexsort([ids[near], -score])[:n]
            out.append(pd.DataFrame({"query_id": query_ids[k], "vec_id": ids[near[best]], "score": score[best]}))
    if not out:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    return pd.concat(out)


def search(vectors: DataFrame, is_query: Column, top: int = TOP, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for every row that ``is_query`` admits.

    Takes part what is ``usable``, has a vec_id and the most common length. A vec_id
    stands for one vector: of several rows the least vector counts. The parts number about
    a third of the root of the vectors unless given. A part is compared in blocks of
    BLOCK_VECTORS by BLOCK_QUERIES, so a part with a third of all vectors is many tasks.
    A query has ``top`` rows, or as many as there are other vectors.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = materialise(rows.groupBy("vec_id").agg(F.min("x").alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.col("n").desc(), "d").first()
    d, n = (common.d, common.n) if common else (1, 0)
    rows = rows.filter(F.size("x") == d)
    place = F.md5(F.col("vec_id").cast("string"))
    share = F.conv(F.substring(place, 1, 8), 16, 10).cast("double") / 2**32
    most = SAMPLE + TRIALS
    drawn = rows.filter(share < 2.0 * most / max(n, 1)).orderBy(place).limit(most).select("vec_id", "x").toPandas()
    held_out = min(TRIALS, len(drawn) // 10)
    drawn_ids = drawn["vec_id"].to_numpy(np.int64)
    sample = np.array(drawn["x"].tolist(), dtype=np.float64).reshape(-1, d)
    trials, sample = sample[:held_out], sample[held_out : held_out + SAMPLE]
    if parts is None:
        parts = max(8, 2 ** round(math.log2(max(1.0, math.sqrt(n) / 3))))
    parts = max(1, min(parts, 1 << max(0, (len(sample) // PER_PART).bit_length() - 1)))
    router = fit(sample, parts, top)
    if len(router.offset) > 1:
        router.probes = measure(rows, router, drawn_ids[:held_out], trials, top)
    shared = spark.sparkContext.broadcast(router)  # parts x HIDDEN numbers

    @F.pandas_udf(ArrayType(IntegerType()))
    def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            found = shared.value.parts(np.array(x.tolist(), dtype=np.float64).reshape(-1, d), shared.value.probes)
            yield pd.Series(list(found.astype(np.int32)))

    routed = materialise(rows.select("vec_id", "x", route("x").alias("parts"), is_query.alias("asks")), "routed")
    held = materialise(routed.groupBy(F.col("parts")[0].alias("part")).agg(F.count(F.lit(1)).alias("held")), "held")
    # a query whose parts hold too few vectors searches all; its own part holds few, so such queries are few
    sizes = {r.part: r.held for r in held.collect()}  # one row per part
    size = F.array(*[F.lit(sizes.get(p, 0)).cast("long") for p in range(len(router.offset))])
    reached = F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + F.get(size, p))
    every_part = F.sequence(F.lit(0), F.lit(len(router.offset) - 1))
    searched = F.when(reached < min(top + 1, n), every_part).otherwise(F.col("parts"))
    asked = routed.filter("asks").select(F.explode(searched).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("asked"))
    blocks = held.join(asked, "part").select(  # one row per part
        "part",
        F.ceil(F.col("held") / BLOCK_VECTORS).cast("int").alias("cuts"),
        F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("turns"),
    )
    mine, every = F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int"), lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    stored = routed.select(F.col("parts")[0].alias("part"), "vec_id", "x").join(blocks, "part")
    stored = stored.select("part", mine.alias("cut"), every("turns").alias("turn"), F.col("vec_id").alias("id"), F.col("x").alias("there"))
    asking = routed.filter("asks").select(F.explode(searched).alias("part"), "vec_id", "x").join(blocks, "part")
    turn = F.pmod(F.xxhash64("vec_id"), F.col("turns")).cast("int")
    asking = asking.select("part", every("cuts").alias("cut"), turn.alias("turn"), F.col("vec_id").alias("query_id"), F.col("x").alias("here"))

    def compare(there: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        vectors, queries = (np.array(x.tolist(), dtype=np.float64).reshape(-1, d) for x in (there["there"], here["here"]))
        return nearest(here["query_id"].to_numpy(np.int64), queries, there["id"].to_numpy(np.int64), vectors, top)

    key = ["part", "cut", "turn"]
    found = stored.groupBy(*key).cogroup(asking.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
