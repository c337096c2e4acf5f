from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.metrics import apply_filters
from millrace.plans import dashboard
from millrace.plans.cube import GRAINS, WIDGETS, Cube, widget
from millrace.plans.medallion import FACT
from millrace.sources.slices import SliceTable
from tests.conftest import rows


def fact(spark, seed, days):
    rng = random.Random(seed)
    data = [
        (f"S{s}", zone, dt.date(2026, 1, 1) + dt.timedelta(days=d), h, Decimal(rng.randrange(-500, 9999)) / 100, None,
         Decimal(rng.randrange(1000, 3000)) / 1000, None if rng.random() < 0.2 else Decimal(rng.randrange(-500, 99999)) / 100)
        for s, zone in ((1, "PL"), (2, "FR"), (3, "PL"), (4, "a:b")) for d in days for h in range(0, 24, 7)
    ]
    return spark.createDataFrame(data, FACT.schema())


def same(cube, df):
    for choice in ({}, {"bidding_zone": "PL"}, {"bidding_zone": None}, {"bidding_zone": "a:b"}, {"bidding_zone": "none"}):
        for name in WIDGETS:
            rows_of = df.withColumn("day_of_week_name", F.date_format("date", "EEEE")) if name == "total_cost_by_weekday" else df
            want = getattr(dashboard, name)(rows_of, choice)
            got = widget(cube, name, choice)
            assert rows(got.select(*[F.col(c).cast("string") for c in want.columns])) == rows(want.select(*[F.col(c).cast("string") for c in want.columns]))


def test_widgets_are_those_of_the_fact(spark, folder):
    df = fact(spark, 1, range(0, 50, 3))
    cube = Cube(spark, f"{folder}/cube")
    cube.rebuild(df)
    same(cube, df)
    by_site = cube.query(["date"], {"n": F.sum("n_cost")}, {"site_id": "S1"})
    assert rows(by_site) == rows(apply_filters(df, {"site_id": "S1"}).groupBy("date").agg(F.count("cost_per_hour")))
    with pytest.raises(ValueError, match="no grain"):
        cube.query(["date", "hour"], {"n": F.sum("n_cost")})
    assert cube.table.read().select("grain").distinct().count() == len(GRAINS)


def test_only_touched_months_are_rebuilt(spark, folder):
    table = SliceTable(spark, f"{folder}/fact", FACT.schema(), {"zone": F.col("bidding_zone"), "date": F.col("date")})
    first = fact(spark, 2, range(0, 50, 4))
    table.replace(first, table.counts(first))
    cube = Cube(spark, f"{folder}/cube")
    cube.rebuild(first)
    late = fact(spark, 3, [40, 41]).filter("bidding_zone <> 'FR'")
    gone = table.slices(first.filter("date = '2026-01-05' and bidding_zone = 'FR'"))
    changed = table.slices(late) + gone
    before = {r[0] for r in cube.table.read().select("_metadata.file_path").distinct().collect()}
    table.put(late, table.counts(late), changed)
    cube.refresh(table, changed)
    same(cube, table.read())
    kept = before & {r[0] for r in cube.table.read().select("_metadata.file_path").distinct().collect()}
    assert len(kept) == len(before) - len({(c.slice_zone, c.slice_date[:7]) for c in changed})
