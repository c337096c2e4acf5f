from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.operators.spelling import correct_spelling, deletions, nearest_spelling


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def expected(value, known):
    near = sorted((distance(value, k), k) for k in known if distance(value, k) <= 2)
    if not near:
        return None, None
    return (near[0][1] if len([k for d, k in near if d == near[0][0]]) == 1 else None), near[0][0]


def edited(rng, word, n):
    for _ in range(n):
        i = rng.randrange(len(word) + 1)
        word = rng.choice([word[:i] + rng.choice("abé") + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice("abé") + word[i + 1 :]])
    return word


def test_against_all_pairs(spark):
    rng = random.Random(1)
    known = ["", "a", "ab", "abc", "paris", "parma", "warszawa", "łódź", "a" * 13, "ab" * 9, "abcabcabcabcabcabc", "abcabcabcabcabcabd", "x" * 40 + "y"]
    known += ["".join(rng.choice("abc") for _ in range(rng.randrange(3, 20))) for _ in range(60)]
    values = sorted({edited(rng, rng.choice(known), rng.randrange(4)) for _ in range(1200)})
    df = spark.createDataFrame([(v,) for v in values], "v string")
    words = spark.createDataFrame([(k,) for k in known] * 2, "w string")
    got = {r.value: (r.corrected, r.distance) for r in nearest_spelling(df, "v", words, "w").collect()}
    assert got == {v: expected(v, set(known)) for v in values}
    assert sum(c is None for c, _ in got.values()) > 50 and sum(d == 2 and c is not None for c, d in got.values()) > 50


def test_rows_keep_their_other_columns(spark):
    df = spark.createDataFrame([(1, "Pariss"), (2, None), (3, "???"), (1, "Pariss")], "id long, `the city` string")
    known = spark.createDataFrame([("Paris",), ("Rome",), (None,)], "word string")
    got = correct_spelling(df, "the city", known, "word", "city")
    assert got.columns == ["id", "the city", "city"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "Pariss", "Paris"), (1, "Pariss", "Paris"), (2, None, None), (3, "???", None)]
    assert correct_spelling(df, "the city", known.limit(0), "word", "city").filter("city is not null").count() == 0


def test_long_words_have_few_deletions(spark):
    row = spark.range(1).select(F.size(deletions(F.lit("abcdefghijklmnop" * 1000))).alias("n"), deletions(F.lit("")).alias("empty")).first()
    assert row.n == 79 and row.empty == [""]
