from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import sketch
from millrace.llm.common import words


def shingles(text):
    w = words(text)
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("task_bytes", [1 << 22, 20_000])
def test_whole_rows(monkeypatch, odd_rows, odd_docs, no_docs, task_bytes):
    monkeypatch.setattr(sketch, "TASK_BYTES", task_bytes)
    got = sketch.fingerprint_documents(odd_docs).collect()
    assert len(got) == len(odd_rows)
    texts = {}
    for doc_id, text, *_ in odd_rows:
        texts.setdefault(doc_id, []).append(text or "")
    ids = sorted(i for i in texts if i is not None)
    for r in got:
        if r.doc_id is None or len(texts[r.doc_id]) > 1 or r.doc_id == ids[-1]:
            continue
        text = texts[r.doc_id][0]
        after = texts[ids[ids.index(r.doc_id) + 1]][0]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(shingles(text), shingles(edited))) < 0.15
        assert abs(r.near_next - jaccard(shingles(text), shingles(after))) < 0.15
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[6].near_next == 1.0
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == ""
    # rows without an id come last, and the first document follows the last
    last = sorted((r for r in got if r.doc_id is None), key=lambda r: r.n_chars)
    assert [r.n_chars for r in last] == [0, 15]
    assert sketch.fingerprint_documents(no_docs).count() == 0


def test_the_only_document_follows_itself(odd_docs):
    got = sketch.fingerprint_documents(odd_docs.filter("doc_id = 13")).first()
    assert got.near_next == 1.0 and got.edited_sha256 == hashlib.sha256(b"The The THE The").hexdigest()


def test_estimates(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(40):
        n, common = rng.randrange(1, 3000), rng.random()
        a = [f"{rng.random()}" for _ in range(n)]
        cut = int(n * common)
        b = a[:cut] + [f"{rng.random()}" for _ in range(rng.randrange(0, 2000))]
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    x, y = F.col("x"), F.col("y")
    got = df.select("a", "b", sketch.sketch("a").alias("x"), sketch.sketch("b").alias("y")).select(
        "a", "b", sketch.resemblance(x, y).alias("r"), sketch.containment(x, y).alias("c"), sketch.distinct_shingles(x).alias("n"),
        (sketch.merge(x, y) == sketch.merge(y, x)).alias("same"),
    ).collect()
    for r in got:
        a, b = shingles(r.a), shingles(r.b)
        assert r.same and abs(r.r - jaccard(a, b)) < 0.16
        if 2 * len(a) >= len(b):
            assert abs(r.c - (len(a & b) / len(a) if a else 1.0)) < 0.25
        assert r.n == len(a) if len(a) < sketch.K else abs(r.n / len(a) - 1) < 0.35


def test_sketches_of_parts_merge_into_that_of_the_whole(spark):
    parts = [" ".join(f"{p}-{i}" for i in range(200)) for p in range(6)]
    df = spark.createDataFrame([(p % 2, t) for p, t in enumerate(parts)] + [(2, None), (2, "")], "g int, t string")
    merged = sketch.merge_groups(df.select("g", sketch.sketch("t").alias("s")), ["g"], "s")
    got = {r.g: r.s for r in merged.collect()}
    hashes = {r.g: set(r.h) for r in df.select("g", sketch.shingle_hashes(F.col("t")).alias("h")).groupBy("g").agg(F.flatten(F.collect_list("h")).alias("h")).collect()}
    assert got == {g: sorted(h)[: sketch.K] for g, h in hashes.items()}
    assert got[2] == []


def test_rows_of_one_doc_id_are_several_stretches(spark, monkeypatch):
    """A third of the rows have no doc_id and a third share one; no task holds all of either, and the order is the same."""
    monkeypatch.setattr(sketch, "TASK_BYTES", 600)
    rows = [([None, 7, i][i % 3], f"text {i} of many words, number {i * i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = sketch.in_order(docs).select("*", F.spark_partition_id().alias("task"), F.xxhash64("text").alias("h")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    found.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    assert [r.next_text for r in found] == [r.text for r in found[1:] + found[:1]]
    for one in (None, 7):
        tasks = [r.task for r in found if r.doc_id == one]
        assert max(map(tasks.count, set(tasks))) < len(tasks) / 2
