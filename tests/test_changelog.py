"""History from a log against a plain model, over random logs, splits and orders."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.changelog import apply_late_changes, build_history, overlapping
from millrace.operators.history import apply_changes
from millrace.session import materialise
from tests.conftest import rows

SCHEMA = "case int, k string, at timestamp, seq int, a int, b string, gone boolean"
DIM = "sk long, case int, k string, a int, b string, valid_from timestamp, valid_to timestamp, is_current boolean"
LOG = {"keys": ["case", "k"], "tracked": ["a", "b"], "at": "at", "sequence": ["seq"], "deleted": "gone"}
START = dt.datetime(2026, 1, 1)


def entries(rng, cases, most, keys="abc"):
    out = []
    for case in range(cases):
        for seq in range(rng.randint(0, most)):
            at = START + dt.timedelta(days=rng.randrange(8))
            out.append((case, rng.choice(keys), at, seq, rng.choice([None, 1, 2]), rng.choice([None, "x"]), rng.random() < 0.2))
    return out


def model(log):
    """Versions by walking along the log of each key."""
    newest = {}
    for case, k, at, seq, a, b, gone in log:
        if (case, k, at) not in newest or seq > newest[case, k, at][0]:
            newest[case, k, at] = (seq, a, b, gone)
    out, open_version = [], {}
    for case, k, at in sorted(newest):
        _, a, b, gone = newest[case, k, at]
        last = open_version.get((case, k))
        if last is not None and (gone or last[:2] != (a, b)):
            out.append((case, k, *last, at, False))
            last = None
        if last is None and not gone:
            open_version[case, k] = (a, b, at)
        elif gone:
            open_version.pop((case, k), None)
    out += [(*key, *version, None, True) for key, version in open_version.items()]
    return sorted(out, key=str)


def listed(df):
    return sorted(map(tuple, df.select("case", "k", "a", "b", "valid_from", "valid_to", "is_current").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_log_at_once(spark, seed):
    log = entries(random.Random(seed), 150, 14)
    built = build_history(spark.createDataFrame(log, SCHEMA), **LOG)
    assert listed(built) == model(log)
    assert overlapping(built, ["case", "k"]).count() == 0


def test_one_key_in_many_tasks(spark):
    """A key with most entries is cut into tasks; runs and ends go across the cuts, equal values over whole tasks too."""
    rng = random.Random(3)
    hot = [(0, "hot", START + dt.timedelta(minutes=i), i, (i // 700) % 2 if i < 4000 else rng.choice([1, 2]), "x", i in (100, 101, 4500)) for i in range(6000)]
    log = hot + entries(rng, 5, 9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert listed(build_history(spark.createDataFrame(log, SCHEMA), **LOG)) == model(log)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_any_order_and_split(spark, seed):
    rng = random.Random(seed)
    log = entries(rng, 60, 12)
    shuffled = rng.sample(log, len(log))
    cuts = sorted(rng.randrange(len(log)) for _ in range(3))
    batches = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    batches.insert(2, batches[0])  # one is applied again
    dim, applied = spark.createDataFrame([], DIM), spark.createDataFrame([], SCHEMA)
    for batch in batches:
        part = spark.createDataFrame(batch, SCHEMA)
        before = dim
        dim = materialise(apply_late_changes(dim, applied, part, surrogate="sk", **LOG), "dim")
        applied = applied.unionByName(part)
        kept = before.join(dim, ["case", "k", "valid_from"]).filter(before.sk != dim.sk)
        assert kept.count() == 0  # versions that stay keep their surrogate
    assert listed(dim) == model(log)
    assert dim.select("sk").distinct().count() == dim.count()
    again = apply_late_changes(dim, applied, spark.createDataFrame(log[:20], SCHEMA), surrogate="sk", **LOG)
    assert rows(again.select(dim.columns)) == rows(dim)


def test_a_late_change_splits_a_closed_version(spark):
    at = [dt.datetime(2024, m, 1) for m in (1, 3, 5)]
    one = [(0, "k", at[0], 0, 1, None, False), (0, "k", at[2], 0, 3, None, False)]
    late = [(0, "k", at[1], 0, 2, None, False)]
    frames = [spark.createDataFrame(part, SCHEMA) for part in (one, late)]
    dim = apply_late_changes(spark.createDataFrame([], DIM), spark.createDataFrame([], SCHEMA), frames[0], surrogate="sk", **LOG)
    dim = apply_late_changes(dim, frames[0], frames[1], surrogate="sk", **LOG)
    assert sorted((r.sk, r.a, r.valid_from, r.valid_to) for r in dim.collect()) == [(1, 1, at[0], at[1]), (2, 3, at[2], None), (3, 2, at[1], at[2])]


def test_a_value_seen_again_counts_after_a_late_change(spark):
    """A, then A again, then late B between them: A holds again from its second entry on."""
    days = [START + dt.timedelta(days=d) for d in range(3)]
    log = [(0, "k", days[0], 0, 1, None, None), (0, "k", days[2], 0, 1, None, None)]
    late = [(0, "k", days[1], 0, 2, None, None)]
    first, second = spark.createDataFrame(log, SCHEMA), spark.createDataFrame(late, SCHEMA)
    dim = apply_late_changes(spark.createDataFrame([], DIM), first.limit(0), first, surrogate="sk", **LOG)
    assert dim.count() == 1
    dim = apply_late_changes(dim, first, second, surrogate="sk", **LOG)
    assert [(r[2], r[4], r[5]) for r in listed(dim)] == [(1, days[0], days[1]), (1, days[2], None), (2, days[1], days[2])]


def test_entries_without_key_or_time_stop_the_job(spark):
    for row in [(0, None, START, 0, 1, "x", False), (0, "k", None, 0, 1, "x", False)]:
        with pytest.raises(Exception, match="present"):
            build_history(spark.createDataFrame([row], SCHEMA), **LOG).collect()


def test_the_plain_form_refuses_late_changes(spark):
    schema = "sk long, k string, a int, valid_from timestamp, valid_to timestamp, is_current boolean"
    dim = spark.createDataFrame([(1, "k", 1, dt.datetime(2024, 5, 1), None, True), (2, "m", 1, dt.datetime(2024, 1, 1), None, True)], schema)
    late = dt.datetime(2024, 3, 1)
    options = {"keys": ["k"], "tracked": ["a"], "surrogate": "sk", "order": "k", "effective": late}
    with pytest.raises(Exception, match="late change"):
        apply_changes(dim, spark.createDataFrame([("k", 2)], "k string, a int"), **options).collect()
    unchanged = spark.createDataFrame([("k", 1), ("m", 2)], "k string, a int")  # only what changes has to be new enough
    assert apply_changes(dim, unchanged, **options).filter(F.col("k") == "m").count() == 2
