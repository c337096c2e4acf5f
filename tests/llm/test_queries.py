"""The registered queries over the smallest tables: against SQL, or against plain versions."""

from __future__ import annotations

import hashlib
import re
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from millrace.llm import mixing, quality, queries
from millrace.llm.common import words
from tests import compare as comparison
from tests.llm import test_ann, test_sketch, test_substring
from tests.llm.test_mixing import naive
from tests.llm.test_simhash import brute as simhash_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def run(spark, start):
    name = next(n for n in queries.QUERIES if n.startswith(start))
    return queries.QUERIES[name](spark, SF)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, monkeypatch, name):
    monkeypatch.setattr(comparison, "UNWANTED", ("CartesianProduct", "BroadcastNestedLoopJoin"))
    case = SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name])
    assert comparison.compare(spark, comparison.connect(SF), case, SF) == []


@pytest.mark.parametrize("start", ["op9_", "op10_"])
def test_native(spark, start):
    plan = run(spark, start)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_op5(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = test_ann.found(run(spark, "op5_"))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = [len({v for _, v, _ in got[q]} & {v for _, v, _ in test_ann.brute(ids, x, q)}) / 20 for q in got]
    assert np.mean(hits) >= 0.9


def test_op7(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in run(spark, "op7_").collect()}
    for doc_id, text, *_ in docs:
        ids = library.encode(text, add_eos=True)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert tuple(got[doc_id])[1:] == want


def test_op8(spark, docs):
    assert sorted(map(tuple, run(spark, "op8_").collect())) == sorted(simhash_brute(docs))


def test_op10(spark, docs):
    text = {d[0]: d[1] for d in docs}
    ids = sorted(text)
    got = {r.doc_id: r for r in run(spark, "op10_").collect()}
    assert len(got) == len(docs)
    error = []
    for i, after in zip(ids, ids[1:] + ids[:1]):
        quarter = len(text[i]) // 4
        edited = text[i][: len(text[i]) - quarter] + text[after][:quarter]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text[i])
        own = test_sketch.shingles(text[i])
        error.append(abs(got[i].near_edited - test_sketch.jaccard(own, test_sketch.shingles(edited))))
        error.append(abs(got[i].near_next - test_sketch.jaccard(own, test_sketch.shingles(text[after]))))
    assert max(error) < 0.18 and np.mean(error) < 0.03
    assert len({got[i].fingerprint for i in ids}) == len(set(text.values()))


def test_op2_op4_op6(spark, docs):
    """Their answers are tested with their operators; here: every row has one."""
    assert sorted(r.doc_id for r in run(spark, "op2_").collect()) == sorted(d[0] for d in docs)
    assert sorted(r.doc_id for r in run(spark, "op4_").collect()) == sorted(d[0] for d in docs)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert run(spark, "op6_").join(pages, ["page_id", "url"]).count() == pages.count()


def row_key(row):
    parts = ["null" if x is None else str(x) for x in (row[0], row[3])]
    return hashlib.md5(("".join(f"{len(p)}:{p}" for p in parts) + (row[1] or "")).encode()).hexdigest()


def mixed(rows):
    """The texts of the mix, by walking through its rules word by word; one shard per source."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    size = {i: sum(len(words(r[1])) for r in by_source[s]) for i, s in enumerate(sources)}
    target = mixing.targets(size, {i: (3, 1, 2)[i % 3] for i in size}, 1.5 * sum(size.values()))
    block = mixing.BLOCK
    seats = naive([target[i] for i in size], round(sum(target.values()) / block), [-(-2 * size[i] // block) for i in size])
    out = []
    for i, s in enumerate(sources):
        order = sorted(by_source[s], key=lambda r: hashlib.md5(f"mix/{row_key(r)}".encode()).hexdigest())
        line = [(k, w) for k, r in enumerate(order) for w in words(r[1])]
        quota = min(seats[i] * block, 2 * size[i])
        passes, rest = divmod(quota, max(1, size[i]))
        picked = set()
        for b in sorted(range(-(-size[i] // block)), key=lambda b: hashlib.md5(f"mix/{i}/0/{b}".encode()).digest()):
            inside = range(b * block, min(size[i], (b + 1) * block))[:rest]
            picked |= set(inside)
            rest -= len(inside)
        for k, r in enumerate(order):
            own = [p for p, (d, _) in enumerate(line) if d == k]
            part = [line[p][1] for p in own if p in picked]
            out += [(r[0], r[1])] * (passes if own else 0)
            if part:
                out.append((r[0], r[1] if len(part) == len(own) else b" ".join(part).decode()))
    return out


def test_pipeline(spark, docs):
    """Every stage by its plain version, one after the other; the network is the trained one."""
    assert [s[0] for s in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "substring_dedup", "mix_sources", "sentencepiece",
    ]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    network = quality.learned(table, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [d for d, p in zip(docs, quality.probability(network, [d[1] for d in docs])) if p >= 0.3]
    first = {component for _, _, component in simhash_brute(good)}
    alone = [d for d in good if d[0] in first]
    lists, kept = test_substring.brute(alone)
    clean = [(d[0], d[1] if len(w) == len(k) else b" ".join(k).decode(), *d[2:]) for d, w, k in zip(alone, lists, kept)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for doc_id, text in mixed(clean):
        ids = library.encode(text, add_eos=True)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert len(good) < len(docs) and len(alone) < len(good)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(want)


def test_stages_take_odd_rows(spark, odd_rows, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            if name != "sentencepiece":
                assert got.columns == docs.columns
            assert (got.count() > 0) == (docs is odd_docs)


def test_stages_keep_columns_of_any_type(spark):
    """Maps, structs, binary, long numbers beside nulls: every stage gives them back as they were."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "*", "map('a', doc_id) as m", "named_struct('text', doc_id, 'p', array(1, null)) as st", "X'0102' as b",
        "if(doc_id % 2 = 0, 1152921504606846977L, null) as big", "timestamp_ntz'2024-01-01 00:00:00' as ts", "1.5 as d",
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.schema.simpleString() == docs.schema.simpleString(), name
        kept = "m['a'] = doc_id and st.text = doc_id and (big = 1152921504606846977L or doc_id % 2 = 1)"
        assert got.selectExpr("count(*) > 0", f"every({kept})").first() == (True, True), name
