from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from millrace.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_text_are_those_of_the_library(library):
    rng = random.Random(1)
    parts = list("aabbcc  \n\t▁éßñ日本語テスト\U0001f600\x00") + "<s> in ing th the he er re on == -- 00 000 ▁▁ 　   ﬁ".split(" ")
    encoder = spm.Encoder(spm.load(PATH))
    texts = ["", " ", "   ", "▁", "a" * 3000, "ab" * 700, "= " * 300]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text, (ids, decoded) in zip(texts, encoder.encode_all(texts)):
        want = library.encode(text, add_eos=True)
        assert ids == " ".join(map(str, want)), repr(text)
        assert decoded == library.decode(want)
        assert spm.decode(encoder.model, want) == decoded


def test_whole_rows(spark, library, odd_rows, odd_docs, no_docs):
    got = sorted(map(tuple, spm.encode_documents(odd_docs, PATH).collect()), key=str)
    want = []
    for doc_id, text, *_ in odd_rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((
            doc_id, len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        ))
    assert got == sorted(want, key=str)
    assert spm.encode_documents(no_docs, PATH).count() == 0


def test_real_texts(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = docs.select("text", spm.encoding(spark, PATH)("text").alias("e")).select("text", "e.*").collect()
    assert ids and all(r.ids == library.encode(r.text, add_eos=True) for r in ids)
    assert all(r.decoded == r.text for r in ids if "▁" not in r.text)
