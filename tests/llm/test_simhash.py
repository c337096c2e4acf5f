from __future__ import annotations

import re

import numpy as np
import xxhash

from millrace.llm import simhash
from millrace.llm.common import only
from millrace.llm.components import components


def brute(rows):
    """fingerprint and component of each row, by definition."""
    codes = []
    for _, text, *_ in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        codes.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return [(row[0], f"{c:016x}", ids.get(find(i))) for i, (row, c) in enumerate(zip(rows, codes))]


def test_whole_rows(odd_rows, odd_docs, no_docs):
    assert sorted(map(tuple, simhash.report(odd_docs).collect()), key=str) == sorted(brute(odd_rows), key=str)
    assert simhash.report(no_docs).count() == 0


def test_one_document_of_each_group_stays(odd_rows, odd_docs):
    kept = only(odd_docs, simhash.first_of_each(odd_docs))
    assert kept.columns == odd_docs.columns
    want = {c for _, _, c in brute(odd_rows)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def near(rng, n):
    """Codes in dense groups: chains of few changed bits."""
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    codes = base[rng.integers(0, len(base), n)]
    for _ in range(4):
        codes = codes ^ np.where(rng.random(n) < 0.5, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    return np.unique(np.r_[codes, np.uint64(0), ~np.uint64(0)])


def test_the_index_finds_every_pair():
    rng = np.random.default_rng(3)
    codes = near(rng, 1500)
    for keys in (np.zeros(len(codes), int), rng.integers(0, 5, len(codes))):
        index = simhash.GrayIndex(codes, keys)
        got = {(int(a), int(b)) for x, y in index.pairs(2) for a, b in zip(x, y)}
        group = np.sort(keys)
        apart = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :])
        want = {(i, j) for i, j in zip(*np.nonzero((apart <= 2) & (group[:, None] == group[None, :]))) if i < j}
        assert got == want


def test_links_of_busy_keys(spark):
    """With keys of few codes every one is cut again and again; no link is lost."""
    codes = near(np.random.default_rng(4), 600).view(np.int64)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long").repartition(3)
    found = {r.node: r.root for r in components(simhash.links(df, key_rows=6)).collect()}
    u = codes.view(np.uint64)
    label = np.arange(len(u))
    apart = np.bitwise_count(u[:, None] ^ u[None, :]) <= 2
    for _ in range(len(u)):
        new = np.array([label[row].min() for row in apart])
        if (new == label).all():
            break
        label = new
    got = [found.get(int(c), int(c)) for c in codes]
    assert len(set(zip(got, label.tolist()))) == len(set(got)) == len(set(label.tolist()))


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(500, 400), (7, 7)], "a long, b long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {400: 400, 500: 400}
