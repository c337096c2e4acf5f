"""The two trained text models: quality and language."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, quality
from tests.llm.conftest import frame

SYLLABLES = {"en": "the ing and tion wh th er re".split(), "de": "sch ein ung ich keit ß ü ver".split(), "fr": "eau é oi que aux è ment tre".split()}


def invented(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        lang = rng.choice(list(SYLLABLES))
        text = invented(rng, lang, rng.randrange(20, 200))
        good = i % 3 > 0
        if not good:
            text = " ".join(w + rng.choice(["***", "&&&", "!!"]) for w in text.split())
        rows.append((i, text, lang, "s", len(text)))
        marks.append((i, int(good), 0))
    return rows, marks


def test_chunks_cover_the_whole_text_and_overlap():
    text = "".join(chr(33 + i % 90) for i in range(1000))
    rows, counts = quality.chunks([text, None, "", "ab"])
    assert counts.tolist() == [4, 1, 1, 1]
    own = rows[:4]
    assert bytes(own[:, : quality.CHUNK].ravel()).rstrip(b"\0") == text.encode()
    assert (own[:-1, quality.CHUNK :] == own[1:, : quality.WIDTH - 1]).all() and not rows[4].any()


def test_pooling_is_the_maximum_over_all_windows():
    rng = np.random.default_rng(1)
    net = quality.Network(rng.normal(size=(quality.WIDTH, 256, 3)).astype(np.float32), np.zeros(3, np.float32), rng.normal(size=6), 0.1)
    text = "some text of more than one chunk " * 20
    rows, counts = quality.chunks([text])
    padded = np.frombuffer(text.encode() + bytes(int(counts[0]) * quality.CHUNK - len(text) + quality.WIDTH - 1), np.uint8)
    every = np.stack([sum(net.taps[j, padded[t + j]] for j in range(quality.WIDTH)) for t in range(int(counts[0]) * quality.CHUNK)])
    want = np.maximum(every.reshape(int(counts[0]), quality.CHUNK, 3).max(axis=1), 0)
    assert np.allclose(quality.pooled(net, rows)[0], want, atol=1e-5)
    features = np.r_[want.max(axis=0), want.mean(axis=0)]
    assert np.allclose(quality.probability(net, [text]), 1 / (1 + np.exp(-(features @ net.weights + net.offset))), atol=1e-5)


def test_quality_of_texts_that_were_held_out(spark, corpus):
    rows, marks = corpus
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [m for m in marks if zlib.crc32(str(m[0]).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in marks)
    right = sum(got[i].predicted == good for i, good, _ in held) / len(held)
    assert right >= 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_quality_of_odd_rows(spark, odd_rows, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 0), (4, None, 0), (4, 1, 0), (4, 0, 0), (5, 0, 1), (99, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        got = quality.score_documents(odd_docs, labels).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(no_docs, odd).count() == 0


def test_labels_without_documents_do_not_crowd_out_the_sample(spark):
    """A hundred times as many labels of other documents: every labelled document that fits is still learned from."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["good", "plain", "words"] if i % 2 else ["$$", "!!", "99"]) for _ in range(40)), "en", "a", 1) for i in range(90)]
    docs = frame(spark, rows)
    own = [(i, i % 2, 0) for i in range(90)]
    foreign = [(1000 + i, 1, 0) for i in range(9000)]
    sample = quality.labelled_sample(docs, spark.createDataFrame(own + foreign, "doc_id long, quality int, toxic int"), F.lit(True), most=80)
    assert len(sample) == 80 and set(sample["doc_id"]) <= set(range(90))
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, spark.createDataFrame(own + foreign, "doc_id long, quality int, toxic int")).collect()}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if not i % 2)


def test_language_kernel_counts_common_grams():
    rows, lettered = langid.presence(["ab", "abc", "12", None])
    assert lettered.tolist() == [True, True, False, False]
    # ' ', a, b; ' a', 'ab', 'b '; ' ab', 'ab '
    assert rows.sum(axis=1).tolist() == [8, 11, 3, 2]
    assert int((rows[0] & rows[1]).sum()) == 6
    model = langid.fit(["abc", "abd", "xyz"], ["p", "p", "q"])
    kernel = model.kernel(langid.presence(["abc", "xyz"])[0])
    assert np.allclose(kernel.max(axis=1), 1)


def test_presence_of_long_texts_is_that_of_the_whole(monkeypatch):
    text = "".join(random.Random(1).choice("abcé ßx") for _ in range(500))
    whole, _ = langid.presence([text, "", "a"])
    monkeypatch.setattr(langid, "CHARACTERS_AT_ONCE", 7)
    assert (langid.presence([text, "", "a"])[0] == whole).all()


def test_language_of_texts_that_were_held_out(spark, corpus):
    rows, _ = corpus
    got = {r.doc_id: r for r in langid.predict_documents(frame(spark, rows)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[r[0]].held_out for r in held) and len(got) == len(rows)
    assert sum(got[r[0]].lang_pred == r[2] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark, odd_rows, odd_docs, no_docs):
    got = langid.predict_documents(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].lang_pred == by_id[2].lang_pred == by_id[3].lang_pred == "und"
    assert by_id[6].lang_pred in {"en", "de", "fr", "es"}
    assert langid.predict_documents(no_docs).count() == 0
    unlabelled = frame(spark, [(i, "words", None, "a", 5) for i in range(8)])
    assert {r.lang_pred for r in langid.predict_documents(unlabelled).collect()} == {"und"}


def test_given_texts(spark):
    """Accuracy on the held-out rows of the given tables."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = langid.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    n, right = found.selectExpr("count(*)", "count_if(lang = lang_pred)").first()
    assert n > 100 and right / n >= 0.95
    scored = quality.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "quality").collect()
    good, bad = [r.score for r in scored if r.quality], [r.score for r in scored if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_long_texts_are_learned_from(spark):
    """All texts are longer than 32 KiB: quality and languages are learned from them and told apart among held-out ones."""
    rng = random.Random(6)
    of_lang = {"en": "the weather of this town was rather good and warm".split(), "fi": "hyvää päivää tässä on pitkä teksti joka jatkuu".split()}
    rows, marks = [], []
    for i in range(60):
        lang, good = ("en", "fi")[i % 2], i // 2 % 2
        text = " ".join(rng.choice(of_lang[lang]) + ("" if good else "$$ 99 !!") for _ in range(8000))
        rows.append((i, text, lang, "a", len(text)))
        marks.append((i, good, 0))
    assert min(len(r[1]) for r in rows) > 1 << 15
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect() if r.held_out}
    assert min(s for i, s in scores.items() if i // 2 % 2) > 0.6 > 0.4 > max(s for i, s in scores.items() if not i // 2 % 2)
    langs = {r.doc_id: r.lang_pred for r in langid.predict_documents(docs).collect() if r.held_out}
    assert langs and all(lang == ("en", "fi")[i % 2] for i, lang in langs.items())
