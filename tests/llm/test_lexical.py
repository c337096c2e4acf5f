from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(lexical.UPPER, lexical.LOWER)))


def brute(docs, items, top=10):
    """Every document against every item, in Python's whole numbers."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in merged.items():
        points = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                points.append((-score, i is None, i, score))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(sorted(points, key=lambda p: (*p[:2], p[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def zipf(rng, n, vocabulary=400):
    return " ".join(f"W{int(vocabulary ** rng.random())}" for _ in range(n))


def test_terms_of_a_text():
    assert terms("Don't STOP-ÉÀ x²,日本 \x00a") == ["don", "t", "stop", "ÉÀ", "x²", "日本", "a"]
    for text in ("Don't STOP-ÉÀ x²,日本 \x00a", "", " ", "A_b[c]{d}~e\x7ff", "\xa0z"):
        folded = lexical.FOLD[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().split()
        assert [t.decode() for t in folded] == terms(text)


def test_odd_rows(spark, odd_rows, odd_docs, no_docs):
    texts = [(1, "w1 W2 w3, w299 x"), (2, None), (3, ""), (None, "日本語 words"), (4, "nowhere"), (5, "w7 " * 50), (5, "two w8"), (6, " ".join(f"w{i}" for i in range(300)))]
    items = spark.createDataFrame(texts, "item_id long, text string").withColumn("score", F.lit(1))
    got = sorted(map(tuple, lexical.search(odd_docs, items).collect()), key=str)
    assert got == brute([(d[0], d[1]) for d in odd_rows], texts)
    assert got
    assert lexical.search(no_docs, items).collect() == []
    assert lexical.search(odd_docs, items.limit(0)).collect() == []
    assert lexical.search(odd_docs, items.filter("item_id in (2, 3, 4)")).collect() == []


@pytest.mark.parametrize("setting", [{}, {"POSTINGS_AT_ONCE": 200}, {"TERMS_AT_ONCE": 40}, {"BYTES_AT_ONCE": 500}])
def test_parts_and_blocks(spark, monkeypatch, setting):
    """The answer does not depend on how postings and items are cut; equal texts tie by doc_id."""
    for name, value in setting.items():
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(4)
    texts = [zipf(rng, rng.randrange(1, 60)) for _ in range(150)]
    docs = [(i, texts[i % 150]) for i in range(400)]
    rng.shuffle(docs)
    items = [(f"q{k}", zipf(rng, 12)) for k in range(15)]
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def part(rng, n_docs, n_terms):
    held = [np.sort(rng.choice(n_terms, size=rng.integers(1, n_terms), replace=False, p=1 / np.arange(1, n_terms + 1) / (1 / np.arange(1, n_terms + 1)).sum())) for _ in range(n_docs)]
    counts = np.array([len(h) for h in held])
    terms = np.concatenate(held)
    tfs = rng.integers(1, 5, len(terms))
    df = np.bincount(terms, minlength=n_terms)
    weights = np.array([lexical.weight(n_docs, int(d)) for d in df])
    return lexical.part_of(counts, counts, terms, tfs, weights, n_docs, int(tfs.sum())), df


def test_the_limit_spares_accumulators_and_loses_nothing():
    rng = np.random.default_rng(1)
    spared = 0
    for _ in range(60):
        own, df = part(rng, 400, 30)
        wanted = sorted(rng.choice(30, size=8, replace=False).tolist(), key=lambda t: (df[t], t))
        whole = np.zeros(400, dtype=np.int64)
        for t in wanted:
            np.add.at(whole, own.docs[own.bounds[t] : own.bounds[t + 1]], own.adds[own.bounds[t] : own.bounds[t + 1]])
        for floor in (0, int(np.sort(whole)[-5])):
            docs, score = lexical.scores(own, wanted, 10, floor)
            assert (whole[docs] == score).all()  # survivors are exact
            least = max(1, floor, int(np.sort(whole)[-10]))
            assert set(np.flatnonzero(whole >= least)) <= set(docs)
            spared += len(docs) < np.count_nonzero(whole)
    assert spared > 20


def test_long_documents_are_measured_in_whole_numbers():
    n = np.array([1, 10**8, 5 * 10**10], dtype=np.int64)
    got = lexical.length_measure(n, 10**10, 10**13)
    assert got.tolist() == [10 + 90 * int(x) * 10**10 // 10**13 for x in n]
