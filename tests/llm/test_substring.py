from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import substring
from millrace.llm.common import words
from millrace.llm.fmindex import FMIndex
from tests.llm.conftest import frame


def brute(rows, window=35):
    """Kept words of each row, by counting all windows."""
    lists = [words(r[1]) for r in rows]
    count = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        out.append([x for x, k in zip(w, keep) if k])
    return lists, out


def check(rows, got, window=35):
    lists, kept = brute(rows, window)
    want = [(r[0], len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for r, w, k in zip(rows, lists, kept)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def passages():
    """Copies, passages of 34, 35, 36 and more words, overlaps, a passage that many share, runs of one word."""
    rng = random.Random(8)

    def some(n):
        return [f"u{rng.random()}" for _ in range(n)]

    shared = {n: some(n) for n in (34, 35, 36, 50, 90)}
    rows = []
    for i in range(60):
        text = some(rng.randrange(40))
        for n in rng.sample(sorted(shared), 2):
            text += shared[n][: rng.choice([n, n, n - 1])] + some(rng.randrange(5))
        rows.append((i, " ".join(text), "en", "a", 1))
    rows += [(100 + i, " ".join(some(3) + shared[50] + some(3)), "en", "a", 1) for i in range(80)]
    rows += [(200, "the " * 500, "en", "a", 1), (201, "the " * 34, "en", "a", 1), (202, "a b " * 100, "en", "a", 1)]
    rows += [(300, rows[0][1], "en", "a", 1), (300, rows[0][1], "en", "a", 1), (301, " ".join(shared[90]), "en", "a", 1)]
    return rows


def test_whole_rows(odd_rows, odd_docs, no_docs):
    check(odd_rows, substring.report(odd_docs).collect())
    assert substring.report(no_docs).count() == 0


@pytest.mark.parametrize("busy, shard", [(2000, 1 << 19), (3, 1 << 19), (2000, 300), (1, 100)])
def test_passages(spark, monkeypatch, passages, busy, shard):
    monkeypatch.setattr(substring, "BUSY", busy)
    monkeypatch.setattr(substring, "SHARD_WORDS", shard)
    check(passages, substring.report(frame(spark, passages).repartition(3)).collect())


def test_other_windows(spark, passages):
    check(passages, substring.report(frame(spark, passages), 60).collect(), 60)


def test_documents_without_repeats(spark, passages):
    docs = frame(spark, passages)
    kept = substring.without_repeats(docs)
    assert kept.columns == docs.columns
    lists, want = brute(passages)
    expected = [(r[0], r[1] if len(w) == len(k) else b" ".join(k).decode()) for r, w, k in zip(passages, lists, want)]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(expected)
    assert all(r.n_chars in (1, len(r.text)) for r in kept.collect())


def test_matching_statistics():
    rng = np.random.default_rng(1)
    for _ in range(20):
        least = int(rng.integers(3, 12))
        base = rng.integers(1, 6, 400)
        pieces = set()
        for _ in range(150):
            at, n = int(rng.integers(0, 350)), int(rng.integers(least, 30))
            piece = base[at : at + n].copy()
            piece[rng.integers(0, n)] = rng.integers(1, 6)
            pieces.add(tuple(piece.tolist()))
        pieces = sorted(pieces)
        weight = rng.integers(1, 3, len(pieces))
        length = np.array([len(p) for p in pieces])
        text = np.concatenate([np.r_[p, 0] for p in pieces])
        index = FMIndex(text, np.repeat(weight, length + 1))
        count = Counter()
        for p, w in zip(pieces, weight):
            for i in range(len(p) - least + 1):
                count[p[i : i + least]] += int(w)
        want = [sum(1 << i for i in range(len(p) - least + 1) if count[p[i : i + least]] >= 2) for p in pieces]
        assert index.matching(np.cumsum(length + 1) - length - 1, length, least).tolist() == want
        # backward search counts occurrences
        low, high = np.array([0]), np.array([index.n])
        for symbol in reversed(pieces[0][:least]):
            low, high = index.extend(low, high, np.array([symbol]))
        plain = sum(p[i : i + least] == pieces[0][:least] for p in pieces for i in range(len(p)))
        assert int(high[0] - low[0]) == plain


def test_windows_of_busy_anchors_have_shards_enough(spark, monkeypatch):
    """Boilerplate in many variants, each in two documents: its windows are many times the words of its segments."""
    monkeypatch.setattr(substring, "BUSY", 5)
    monkeypatch.setattr(substring, "SHARD_WORDS", 2000)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(50)]
    rows = []
    for i in range(80):
        text = " ".join([*common[:25], f"v{i}", *common[25:]])
        rows += [(2 * i + j, " ".join(f"o{rng.randrange(10**6)}" for _ in range(5)) + " " + text, "en", "a", 1) for j in range(2)]
    seen, write = {}, substring.materialise
    monkeypatch.setattr(substring, "materialise", lambda df, label, **more: seen.setdefault(label, write(df, label, **more)))
    check(rows, substring.report(frame(spark, rows)).collect())
    # every window that is searched alone occurs twice here, so the hits show how many words a shard had
    busy = seen["pieces"].filter("place >= 0").select("anchor", "segment").distinct()
    per_shard = seen["hits"].join(busy, ["anchor", "segment"]).groupBy("shard").count().collect()
    assert sum(r["count"] for r in per_shard) * 35 > 10 * 2000
    assert max(r["count"] for r in per_shard) * 35 < 2 * 2000
