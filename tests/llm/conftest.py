from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

# extra columns whose names an operator might use itself
CLASHING = ["score", "part", "shard", "H1", "row_key", "_key", "text_key", "doc", "spots", "size", "order", "copy", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(i).cast("long") for i, c in enumerate(CLASHING)})


def some_words(rng, n, vocabulary=40):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows and texts, shared passages."""
    rng = random.Random(5)
    passage = " ".join(some_words(rng, 60))
    long_text = " ".join(some_words(rng, 30000, 5000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (None, "no id but words", "de", "b", 15),
        (None, None, None, None, None),
        (3, " \t\n\x0b\x0c\r ", "en", "a", 6),
        (4, "one", "en", "a", 3),
        (5, "two words", "fr", "é", 9),
        (6, long_text, "en", "b", len(long_text)),
        (7, long_text, "en", "b", len(long_text)),
        (8, f"before {passage} after", "en", "a", 9),
        (9, f"other {passage} end", "en", "c", 9),
        (9, f"other {passage} end", "en", "c", 9),
        (10, "x" * 100_000, "en", "b", 100_000),
        (11, "a b c " * 200, "es", "c", 1200),
        (12, "Ünï çödé  日本語 \U0001f600 ▁x \x00 <s>", "fr", "a", 20),
        (13, "The The THE the", "en", "a", 15),
    ]
    for i in range(20, 60):
        text = " ".join(some_words(rng, rng.randrange(1, 120), 300))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("abc"), len(text)))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
