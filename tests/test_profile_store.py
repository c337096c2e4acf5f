from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.operators.profile_store import ProfileStore
from millrace.sources.slices import SliceTable

SCHEMA = "zone string, day date, n long, x double, name string"


def data(rng, days, n):
    return [
        (rng.choice(["a", "b:c", None]), dt.date(2026, 1, 1) + dt.timedelta(days=rng.choice(days)), rng.randrange(n) if rng.random() < 0.9 else None,
         rng.gauss(0, 1), rng.choice([None, "", f"w{rng.randrange(n)}"]))
        for _ in range(n)
    ]


def check(store, rows):
    got = {r.column_name: r for r in store.report([0.25, 0.5]).collect()}
    for k, name in ((2, "n"), (3, "x"), (4, "name")):
        values = sorted(r[k] for r in rows if r[k] is not None)
        r = got[name]
        assert (r.n_rows, r.nulls, r.least, r.greatest) == (len(rows), len(rows) - len(values), str(values[0]), str(values[-1]))
        assert abs(r.n_distinct - len(set(values))) <= 0.06 * len(set(values)) + 1
        if name == "name":
            assert r.quantiles is None
        else:
            for q, share in zip(r.quantiles, (0.25, 0.5)):
                assert abs(sum(v <= q for v in values) / len(values) - share) < 0.05


def test_states_follow_the_slices(spark, folder, monkeypatch):
    rng = random.Random(1)
    first, later = data(rng, [0, 1, 2, 3], 4000), data(rng, [3, 4], 2000)
    frame = spark.createDataFrame(first, SCHEMA)
    table = SliceTable(spark, f"{folder}/t", frame.schema, {"zone": F.col("zone"), "day": F.col("day")})
    table.replace(frame, table.counts(frame))
    store = ProfileStore(spark, f"{folder}/p", table, {"zone": "zone", "day": "day"}, ["n", "x", "name"])
    store.rebuild()
    check(store, first)
    new = spark.createDataFrame(later, SCHEMA)
    gone = table.slices(frame.filter("day = '2026-01-01' and zone = 'a'"))  # emptied
    changed = table.slices(new) + gone
    table.put(new, table.counts(new), changed)
    opened = []
    plain = SliceTable._files
    monkeypatch.setattr(SliceTable, "_files", lambda self, *paths: opened.append(paths) or plain(self, *paths))
    store.refresh(changed)
    assert len(opened) == 1 and len(opened[0]) == 6  # three zones on two days; nothing else of the table
    left = [r for r in first if r[1].day < 4 and not (r[1].day == 1 and r[0] == "a")] + later
    check(store, left)
    by_zone = {r.zone: r.n_rows for r in store.report(by=["zone"]).filter("column_name = 'x'").collect()}
    assert by_zone == {z: sum(r[0] == z for r in left) for z in ("a", "b:c", None)}


def test_columns_without_values(spark, folder):
    frame = spark.createDataFrame([("a", dt.date(2026, 1, 1), None, None, None)], SCHEMA)
    table = SliceTable(spark, f"{folder}/t", frame.schema, {"zone": F.col("zone")})
    table.replace(frame, table.counts(frame))
    store = ProfileStore(spark, f"{folder}/p", table, {"zone": "zone"}, ["n", "name"])
    store.rebuild()
    assert [tuple(r) for r in store.report().collect()] == [("n", 1, 1, None, None, 0, None), ("name", 1, 1, None, None, 0, None)]
