from __future__ import annotations

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann


def brute(ids, x, query, top=20):
    score = (x * x[ids == query][0]).sum(axis=1)
    order = [i for i in np.lexsort([ids, -score]) if ids[i] != query][:top]
    return [(k + 1, int(ids[i]), float(score[i])) for k, i in enumerate(order)]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(16, 8)) * 4
    x = centres[np.arange(1024) % 16] + rng.normal(size=(1024, 8)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = ann.neighbours(x, 10)
    part = ann.balanced_parts(x, graph, 8)
    assert np.bincount(part, minlength=8).tolist() == [128] * 8
    assert (part[graph] != part[:, None]).mean() < 0.25
    router = ann.fit(x, 8)
    assert router.probes <= 4


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = found(ann.search(vectors, F.col("vec_id") % 20 == 0))
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    recall = []
    for q, near in got.items():
        want = brute(ids, x, q)
        assert [r for r, _, _ in near] == list(range(1, 21))
        by_id = dict(zip(ids.tolist(), x))
        assert all(abs(s - float(by_id[q] @ by_id[v])) < 1e-12 for _, v, s in near)
        recall.append(len({v for _, v, _ in near} & {v for _, v, _ in want}) / 20)
    assert np.mean(recall) >= 0.9


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 3)]) for i in range(30)]
    rows += [(40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (140, []), (160, [1.0, 2.0, 3.0])]
    rows += [(None, [1.0, 1.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as parts", "2 as X", "3 as score")
    got = found(ann.search(df, F.col("vec_id") % 20 == 0))
    ids, x = np.arange(30), np.array([[1.0, float(i % 3)] for i in range(30)])
    assert got == {q: brute(ids, x, q) for q in (0, 20)}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = df.filter("vec_id in (0, 1, 2)")
    assert found(ann.search(few, F.col("vec_id") % 20 == 0)) == {0: brute(ids[:3], x[:3], 0)}


def test_blocks_of_a_crowded_part(spark, monkeypatch):
    """A third of the vectors are one vector; parts are compared in many small blocks."""
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 6))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(900)], "vec_id long, embedding array<double>")
    got = found(ann.search(df, F.col("vec_id") % 20 == 0, parts=1))
    for q, near in got.items():
        assert [v for _, v, _ in near] == [v for _, v, _ in brute(np.arange(900), x, q)]
    assert len(got) == 45


def test_recall_beyond_the_sample(spark, monkeypatch):
    """Nearly all vectors are unseen by the router, and what the sample says of itself is too good."""
    monkeypatch.setattr(ann, "SAMPLE", 512)
    fit = ann.fit
    monkeypatch.setattr(ann, "fit", lambda *args: dataclasses.replace(fit(*args), probes=1))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 12))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(6000)], "vec_id long, embedding array<double>")
    got = found(ann.search(df, F.col("vec_id") % 20 == 0))
    want = {q: {v for _, v, _ in brute(np.arange(6000), x, q)} for q in range(0, 6000, 20)}
    recall = [len({v for _, v, _ in got[q]} & near) / 20 for q, near in want.items()]
    assert np.mean(recall) >= 0.94


def test_full_lists_from_uneven_parts(spark, monkeypatch):
    """A third of the vectors are one vector, so that other routed parts hold very few; each query searches one part."""
    monkeypatch.setattr(ann, "WANTED", 0.0)
    monkeypatch.setattr(ann, "SPARE", 0)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 6))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(900)], "vec_id long, embedding array<double>")
    got = found(ann.search(df, F.lit(True), parts=16))
    assert sorted(got) == list(range(900))
    assert all([r for r, _, _ in near] == list(range(1, 21)) for near in got.values())
