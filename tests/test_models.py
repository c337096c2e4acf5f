"""Mutating operators against plain Python models, over many random cases at once.

The number of the case is part of every key, so one Spark run checks all of them.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest

from millrace.operators.dedup import keep_latest
from millrace.operators.history import apply_changes, as_of_lookup, seed_history
from millrace.operators.upsert import upsert, upsert_sequenced
from millrace.sources.batches import BatchTable
from millrace.streaming.cdc import current, settle
from tests.conftest import rows

CASES = 150
ROW = "case int, k string, seq int, v int"


def _random_rows(seed, most, unique=False):
    rng, out = random.Random(seed), []
    for case in range(CASES):
        seen = set()
        for _ in range(rng.randint(0, most)):
            k = rng.choice("abcde")
            if unique and k in seen:
                continue
            seen.add(k)
            out.append((case, k, rng.choice([None, 1, 2, 3, 4]), rng.randint(0, 9)))
    return out


def _rank(row):
    """Higher wins: sequence, then value; NULL is lowest."""
    return (row[2] is not None, row[2] or 0, row[3])


def _latest(data):
    best = {}
    for row in data:
        if row[:2] not in best or _rank(row) > _rank(best[row[:2]]):
            best[row[:2]] = row
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_keep_latest(spark, seed):
    data = _random_rows(seed, 12)
    got = rows(keep_latest(spark.createDataFrame(data, ROW), ["case", "k"], "seq"))
    assert sorted(got, key=str) == sorted(_latest(data).values(), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_upserts(spark, seed):
    target, updates = _random_rows(seed, 5, unique=True), _random_rows(seed + 100, 6)
    t, u = spark.createDataFrame(target, ROW), spark.createDataFrame(updates, ROW)
    settled = _latest(updates)

    plain = {r[:2]: r for r in target} | settled
    newest = keep_latest(u, ["case", "k"], "seq")
    assert sorted(rows(upsert(t, newest, ["case", "k"])), key=str) == sorted(plain.values(), key=str)

    guarded = {r[:2]: r for r in target}
    for key, row in settled.items():
        held = guarded.get(key)
        if held is None or (row[2] is not None and (held[2] is None or row[2] > held[2])):
            guarded[key] = row
    assert sorted(rows(upsert_sequenced(t, u, ["case", "k"], "seq")), key=str) == sorted(guarded.values(), key=str)


def test_current_rows_over_many_batches(spark, folder):
    table = BatchTable(spark, folder)
    rng, everything = random.Random(7), []
    for step in range(5):
        batch = _random_rows(200 + step, rng.choice([1, 4]))
        everything += batch
        for _ in range(rng.choice([1, 2])):  # a replay
            table.write(spark.createDataFrame(batch, ROW), "run", step)
        assert sorted(rows(current(table, ["case", "k"], "seq")), key=str) == sorted(_latest(everything).values(), key=str)
    settled = settle(table, f"{folder}-settled", ["case", "k"], "seq")
    assert sorted(rows(settled), key=str) == sorted(_latest(everything).values(), key=str)


def _day(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=n)


def test_history_over_many_batches(spark):
    rng = random.Random(11)
    keys = [(case * 10 + site) for case in range(CASES) for site in range(3)]
    schema = "site_id int, site_name string, country string"

    def batch(share):
        return [(k, rng.choice(["x", "y", "z", None]), rng.choice(["PL", "DE"])) for k in keys if rng.random() < share]

    first = batch(0.6)
    dim = seed_history(spark.createDataFrame(first, schema), surrogate="dc_key", order="site_id", effective=_day(0))
    model = {k: [[name, country, _day(0), None]] for k, name, country in first}
    for step in (1, 2, 3):
        changes = batch(0.5)
        dim = apply_changes(
            dim, spark.createDataFrame(changes, schema), keys=["site_id"], tracked=["site_name"],
            surrogate="dc_key", order="site_id", effective=_day(step),
        )
        for k, name, country in changes:
            versions = model.setdefault(k, [])
            if versions and (versions[-1][0] is None or name is None or versions[-1][0] == name):
                continue
            if versions:
                versions[-1][3] = _day(step)
            versions.append([name, country, _day(step), None])
    expected = [(k, *v, v[3] is None) for k, versions in model.items() for v in versions]
    got = dim.select("site_id", "site_name", "country", "valid_from", "valid_to", "is_current")
    assert sorted(rows(got), key=str) == sorted(expected, key=str)
    numbers = sorted(r.dc_key for r in dim.select("dc_key").collect())
    assert numbers == list(range(1, len(expected) + 1))

    facts = [(k, _day(d) + dt.timedelta(hours=h)) for k in keys for d, h in ((-1, 23), (0, 0), (1, 0), (2, 12), (5, 0))]
    wanted = []
    for k, ts in facts:
        hit = [v for v in model.get(k, []) if v[2] <= ts and (v[3] is None or ts < v[3])]
        wanted.append((k, ts, hit[0][1] if hit else None))
    df = spark.createDataFrame(facts, "site_id int, at timestamp")
    found = as_of_lookup(df, dim, key="site_id", at="at", columns=["country"])
    assert sorted(rows(found), key=str) == sorted(wanted, key=str)
