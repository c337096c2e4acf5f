from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators.dedup import drop_duplicates, duplicate_groups, duplicate_summary, keep_latest
from millrace.operators.numbering import number_rows
from millrace.operators.upsert import AmbiguousSource, MissingKey, upsert, upsert_sequenced
from tests.conftest import rows

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "zone string, ts int, seq timestamp, price double"


def test_keep_latest_takes_newest_and_breaks_ties_the_same_way(spark):
    data = [("PL", 1, T1, 5.0), ("PL", 1, T2, 6.0), ("FR", 1, T1, 1.0), ("FR", 1, T1, 2.0), (None, 1, T1, 9.0), ("ES", 1, None, 3.0), ("ES", 1, T1, 4.0)]
    expected = [(None, 1, T1, 9.0), ("ES", 1, T1, 4.0), ("FR", 1, T1, 2.0), ("PL", 1, T2, 6.0)]
    for order in (data, data[::-1]):
        assert rows(keep_latest(spark.createDataFrame(order, SCHEMA), ["zone", "ts"], "seq")) == expected


def test_keep_latest_drops_repeats_of_a_hot_key_before_the_shuffle(spark):
    df = spark.range(100).select(F.floor(F.col("id") / 1000).alias("k"), F.col("id").alias("seq"))
    plan = keep_latest(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_latest_of_few_copies_sorts_once_and_keeps_the_same_rows(spark):
    data = [("PL", 1, T1, 5.0), ("PL", 1, T2, 6.0), ("PL", 1, T2, 7.0), ("FR", 1, None, 1.0), (None, 1, T1, 9.0), (None, 1, T1, 9.0), (None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    few = keep_latest(df, ["zone", "ts"], "seq", few_copies=True)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and plan.count("Sort [") == 1
    assert rows(few) == rows(keep_latest(df, ["zone", "ts"], "seq")) and few.columns == df.columns


def test_duplicate_counts_ignore_incomplete_keys_like_count_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "b")], "k int, v string")
    assert rows(duplicate_summary(df, ["k", "v"])) == [(5, 2, 3)]
    want = df.selectExpr("count(distinct k, v)").first()[0]
    assert duplicate_summary(df, ["k", "v"]).first().unique_key == want
    assert rows(duplicate_groups(df, ["k", "v"])) == [(1, "a", 2), (2, None, 2)]
    assert drop_duplicates(df, ["k"]).count() == 3


def test_upsert_matches_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "B", 7), (3, "C", 8)], "k int, v string, extra int")
    assert rows(upsert(target, updates, ["k"])) == [(None, "n", None), (1, "a", None), (2, "B", 7), (3, "C", 8)]


def test_updates_without_a_key_are_refused(spark):
    target = spark.createDataFrame([(1, 1, "a"), (None, 1, "n"), (None, 2, "m")], "k int, s int, v string")
    nameless = spark.createDataFrame([(2, 1, "b"), (None, 9, "x")], "k int, s int, v string")
    with pytest.raises(MissingKey):
        upsert(target, nameless, ["k"])
    with pytest.raises(Exception, match="a source row without"):
        upsert_sequenced(target, nameless, ["k"], "s").collect()
    named = nameless.dropna(subset=["k"])
    once = upsert_sequenced(target, named, ["k"], "s")
    assert rows(once) == [(None, 1, "n"), (None, 2, "m"), (1, 1, "a"), (2, 1, "b")]
    assert rows(upsert_sequenced(once, named, ["k"], "s")) == rows(once)


def test_upserts_read_each_input_once(spark, folder):
    for name in ("t", "u"):
        spark.range(9).selectExpr("id as k", "1 as s").write.parquet(f"{folder}/{name}")
    t, u = (spark.read.parquet(f"{folder}/{n}") for n in ("t", "u"))
    for result in (upsert(t, u, ["k"]), upsert_sequenced(t, u, ["k"], "s")):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "Relation" in line]
        assert sum("k#" in line for line in scans) <= 3
        assert str(result.inputFiles()).count("/t/") == len(t.inputFiles())


def test_ties_over_nested_maps(spark):
    df = spark.sql("select id % 3 as k, named_struct('m', map(id, id)) as s, array(map(1, id)) as a, id as v from range(9)")
    assert rows(keep_latest(df, ["k"], []).select("k", "v")) == [(0, 6), (1, 7), (2, 8)]


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    once = upsert(target, updates, ["k"])
    assert rows(upsert(once, updates, ["k"])) == rows(once)


def test_upsert_refuses_two_rows_for_one_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(AmbiguousSource):
        upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])


def test_sequenced_upsert_never_goes_back(spark):
    target = spark.createDataFrame([(1, 5, "five"), (2, 5, "five"), (3, None, "none")], "k int, seq int, v string")
    updates = spark.createDataFrame(
        [(1, 4, "late"), (1, 6, "six"), (1, 3, "older"), (2, 5, "tie"), (3, 1, "first"), (4, 1, "new"), (2, None, "null")],
        "k int, seq int, v string",
    )
    result = upsert_sequenced(target, updates, ["k"], "seq")
    expected = [(1, 6, "six"), (2, 5, "five"), (3, 1, "first"), (4, 1, "new")]
    assert rows(result) == expected
    assert rows(upsert_sequenced(result, updates, ["k"], "seq")) == expected


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_numbers_are_dense_and_follow_the_key(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000 - 500).alias("k")).repartition(parts)
    got = rows(number_rows(df, "k", "n", start=11).orderBy("k"))
    assert sorted(got) == [(k - 500, k + 11) for k in range(1000)]


def test_numbers_for_strings_and_repeated_keys(spark):
    df = spark.createDataFrame([("%02d-site" % (i % 30), i) for i in range(100)], "k string, v int")
    got = [(r.k, r.n) for r in number_rows(df, "k", "n").orderBy("n").collect()]
    assert [n for _, n in got] == list(range(1, 101))
    assert [k for k, _ in got] == sorted(k for k, _ in got)
    assert number_rows(df.limit(0), "k", "n").count() == 0


def test_numbers_of_a_busy_key_are_spread_and_stay_dense(spark):
    """Two thirds of the rows hold two keys; the order of keys is kept."""
    key = F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 3 == 1, 1000).otherwise(F.col("id"))
    df = spark.range(3000).select(key.alias("k"), "id")
    got = [(r.k, r.n) for r in number_rows(df, "k", "n").orderBy("n").collect()]
    assert [n for _, n in got] == list(range(1, 3001))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def test_rows_without_a_key_come_first(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    got = [(r.k, r.n) for r in number_rows(df, "k", "n").orderBy("n").collect()]
    assert [n for _, n in got] == list(range(1, 301))
    assert [k for k, _ in got] == [None] * 100 + [i for i in range(300) if i % 3]
    only_null = spark.range(50).select(F.lit(None).cast("int").alias("k"), "id")
    assert sorted(r.n for r in number_rows(only_null, "k", "n").collect()) == list(range(1, 51))


def test_numbers_of_long_strings_and_odd_numbers(spark):
    names = [f"Customer#000{i:06d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "k string").repartition(7)
    assert [r.k for r in number_rows(df, "k", "n").orderBy("n").collect()] == names
    odd = [float("nan"), float("inf"), -float("inf"), 0.0, 1.5, None] * 40
    got = number_rows(spark.createDataFrame([(x,) for x in odd], "k double"), "k", "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 241))
    assert [str(r.k) for r in got] == [x for x in ("None", "-inf", "0.0", "1.5", "inf", "nan") for _ in range(40)]


def test_numbers_start_anew_in_every_group(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.lit("same").alias("k"), F.lit(None).cast("map<int,int>").alias("m"))
    df = df.unionByName(df.withColumn("g", F.lit(None).cast("long")).limit(10))
    got = number_rows(df, "k", "n", start=0, within=["g"])
    assert rows(got.groupBy("g").agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [
        (None, 0, 9, 10), (0, 0, 99, 100), (1, 0, 99, 100), (2, 0, 99, 100),
    ]
