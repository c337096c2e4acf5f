from __future__ import annotations

import datetime as dt
import itertools
import math
import pathlib

import pytest
from pyspark.sql import functions as F

from millrace.functions.ordering import cuts, interleave, slot_of, with_hilbert_value
from millrace.operators.layout import (
    append_clustered,
    bits_for,
    boxes_report,
    cluster,
    compact,
    current_bounds,
    layout_report,
    rows_scanned,
    scatter,
    skipping_report,
    write_layout,
)
from tests.conftest import rows


def _orders(spark):
    return spark.range(20000).select(
        (F.col("id") * 7919 % 500).cast("int").alias("restaurant"),
        F.expr("date_add(date'2025-01-01', cast(id * 104729 % 365 as int))").alias("day"),
        (F.col("id") % 97).cast("double").alias("amount"),
    )


def test_bits_are_taken_in_turn(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in df.select("a", "b", interleave([F.col("a"), F.col("b")], 3).alias("z")).collect():
        want = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(want, 2)


def test_slots_count_the_cuts_at_or_below(spark):
    nan, inf = float("nan"), float("inf")
    values = [float(x) for x in range(-3, 12)] + [None, inf, -inf, nan]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    cut = [0.0, 2.0, 2.5, 7.0, nan]
    for r in df.select("x", slot_of("x", df.schema["x"].dataType, cut).alias("s")).collect():
        want = 0 if r.x is None else 5 if math.isnan(r.x) else sum(c <= r.x for c in cut)
        assert r.s == want
    assert {r.s for r in df.select(slot_of("x", df.schema["x"].dataType, []).alias("s")).collect()} == {0}


def test_slots_follow_the_order_of_any_type(spark):
    names = [f"Customer#0000{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in names], "w string").repartition(5)
    frames = {"w": df, "d": spark.sql("select date_add(date'2020-01-01', cast(id as int)) as d from range(3000)")}
    for key, frame in frames.items():
        found = cuts(frame, key, 64)
        assert 55 <= len(found) <= 63
        slotted = frame.select(key, slot_of(key, frame.schema[key].dataType, found).alias("s")).orderBy(key).collect()
        slots = [r.s for r in slotted]
        assert slots == sorted(slots) and max(slots.count(s) for s in set(slots)) < 150


def test_slots_are_even(spark):
    df = spark.range(50000).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    for slots in (8, 256):
        found = slot_of("x", df.schema["x"].dataType, cuts(df, "x", slots))
        sizes = [r["count"] for r in df.groupBy(found).count().collect()]
        assert len(sizes) >= slots * 0.95 and max(sizes) < 2.5 * 50000 / slots
    assert cuts(df.limit(0), "x", 8) == []


def test_bits_grow_with_the_files():
    assert bits_for(8, 1) == 5 and bits_for(32, 2) == 5
    assert bits_for(400_000, 2) == 12 and bits_for(400_000, 1) == 21 and bits_for(400_000, 4) == 7


def test_clustered_files_are_skipped_and_answers_agree(spark, folder):
    df = _orders(spark)
    paths = {n: f"{folder}/{n}" for n in ("baseline", "zorder", "zorder_compacted")}
    write_layout(scatter(df, 32), paths["baseline"])
    write_layout(cluster(df, ["restaurant", "day"], 32), paths["zorder"])
    size = layout_report(spark, {"zorder": paths["zorder"]}).first().size_in_bytes
    compact(spark, paths["zorder"], paths["zorder_compacted"], size // 12, ["restaurant", "day"])
    compact(spark, paths["baseline"], f"{folder}/compacted", 64 * 1024)
    assert 1 < layout_report(spark, {"t": f"{folder}/compacted"}).first().num_files < 32
    report = {r.table_name: r for r in skipping_report(spark, paths, {"restaurant": (273, 273)}).collect()}
    assert report["baseline"].files_read == report["baseline"].files_total == 32
    assert report["zorder"].files_read <= 12
    assert report["zorder"].bytes_pruned > 0
    assert report["zorder_compacted"].files_read <= report["zorder_compacted"].files_total // 2
    answers = {
        n: rows(spark.read.parquet(p).filter("restaurant = 273 and day between '2025-06-01' and '2025-06-30'").agg(F.count("*"), F.avg("amount")))
        for n, p in paths.items()
    }
    assert len({str(a) for a in answers.values()}) == 1
    files = {r.table_name: r.num_files for r in layout_report(spark, paths).collect()}
    assert files["zorder_compacted"] < files["zorder"] == 32
    assert rows(spark.read.parquet(paths["zorder"])) == rows(df)


def test_equal_keys_are_still_cut_into_several_files(spark, folder):
    df = spark.range(10000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    write_layout(cluster(df, ["k"], 8), folder)
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 5000


def test_changed_keys_leave_old_files_alone(spark, folder):
    df = _orders(spark)
    write_layout(cluster(df, ["restaurant"], 4), folder)
    old = {r[0] for r in spark.read.parquet(folder).select("_metadata.file_path").distinct().collect()}
    append_clustered(df, folder, ["day"], 4)
    new = {r[0] for r in spark.read.parquet(folder).select("_metadata.file_path").distinct().collect()}
    assert old < new and len(new) == 8


def test_one_name_lies_in_few_files(spark, folder):
    names = spark.range(20000).select(F.format_string("Customer#%012d", F.col("id") % 5000).alias("name"), F.col("id").alias("v"))
    write_layout(cluster(names, ["name"], 16), f"{folder}/one", ["name"])
    write_layout(cluster(names, ["name", "v"], 16), f"{folder}/two", ["name"])
    wanted = {"name": ("Customer#000000002500", "Customer#000000002500")}
    report = {r.table_name: r for r in skipping_report(spark, {"one": f"{folder}/one", "two": f"{folder}/two"}, wanted).collect()}
    assert report["one"].files_read <= 2 and report["one"].files_total == 16
    assert report["two"].files_read <= 8


@pytest.mark.parametrize("axes, bits", [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_hilbert_curve_are_neighbours(spark, axes, bits):
    names = [f"k{i}" for i in range(axes)]
    df = spark.createDataFrame(list(itertools.product(range(2**bits), repeat=axes)), ", ".join(f"{n} int" for n in names)).withColumn("_axis0", F.lit("x"))
    cells = with_hilbert_value(df, "place", [F.col(n) for n in names], bits).orderBy("place").collect()
    assert [c.place for c in cells] == list(range(2 ** (bits * axes))) and cells[0]._axis0 == "x"
    for a, b in zip(cells, cells[1:]):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_the_hilbert_layout_reads_fewer_files(spark, folder):
    df = _orders(spark)
    for curve in ("z", "hilbert"):
        write_layout(cluster(df, ["restaurant", "day"], 64, curve=curve), f"{folder}/{curve}", ["restaurant", "amount"])
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=k * 11 % 300) for k in range(40)]
    boxes = [{"restaurant": (k * 7 % 440, k * 7 % 440 + 50), "day": (day, day)} for k, day in enumerate(days)]
    report = {r.table_name: r for r in boxes_report(spark, {c: f"{folder}/{c}" for c in ("z", "hilbert")}, boxes).collect()}
    assert report["hilbert"].files_read < report["z"].files_read < report["z"].files_total / 4
    with pytest.raises(ValueError, match="curve"):
        cluster(df, ["restaurant", "day"], 4, curve="peano")


def test_bounds_follow_every_writer(spark, folder):
    path, box = f"{folder}/t", {"k": (5, 5)}
    low, high = (spark.range(a, a + 10).selectExpr("id as k", "id as v") for a in (0, 100))

    def report():
        r = skipping_report(spark, {"t": path}, box).first()
        return r.files_total, r.files_read

    write_layout(cluster(low, ["k"], 2), path, ["k"])
    assert report() == (2, 1)
    append_clustered(high, path, ["k"], 2)
    assert report() == (4, 1) and spark.read.parquet(f"{path}-bounds").count() == 4
    low.coalesce(1).write.mode("append").parquet(path)  # by somebody else
    assert report() == (5, 2) and spark.read.parquet(f"{path}-bounds").count() == 4
    for p in pathlib.Path(path).glob("*.parquet"):
        if spark.read.parquet(str(p)).filter("k >= 100").count():
            p.unlink()
    assert report() == (3, 2)
    assert {r.lo_v for r in current_bounds(spark, path, ["v"]).collect()} == {0, 5}  # a column without stored bounds is scanned
    write_layout(high.coalesce(1), path)
    assert report() == (1, 0) and not pathlib.Path(f"{path}-bounds").exists()
    write_layout(cluster(low, ["k"], 2), path, ["k"])
    compact(spark, path, path + "2")
    assert skipping_report(spark, {"t": path + "2"}, box).first().files_read == 1


def test_lookups_read_few_rows(spark, folder):
    df = spark.range(40000).selectExpr("id * 7919 % 1000003 as k", "id as v")
    write_layout(scatter(df, 100), f"{folder}/plain")
    write_layout(scatter(df, 100), f"{folder}/bloom", lookup=["k"], rows_per_file=500)
    read = {}
    for name in ("plain", "bloom"):
        hits = [spark.read.parquet(f"{folder}/{name}").filter(F.col("k") == v * 7919 % 1000003) for v in range(0, 40000, 8000)]
        assert [[r.v for r in h.collect()] for h in hits] == [[v] for v in range(0, 40000, 8000)]
        read[name] = sum(rows_scanned(h) for h in hits) / len(hits)
    assert read["bloom"] < 0.02 * 40000 < read["plain"]
    none = spark.read.parquet(f"{folder}/bloom").filter("k = -5")
    assert none.collect() == [] and rows_scanned(none) < 0.02 * 40000


def test_files_follow_the_number_of_rows(spark, folder, monkeypatch):
    import millrace.operators.layout as layout
    from workload import layouts

    days = F.array(*[F.lit(dt.datetime(y, 6, 1)) for y in (1996, 1997, 1998, 2000)])
    day = F.get(days, F.floor(F.col("id") / 7 % 4).cast("int"))
    lines = spark.range(8000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7919 % 4000).alias("l_partkey"), (F.col("id") * 31 % 1000).alias("l_suppkey"),
        day.alias("l_shipdate"), F.lit("A").alias("l_returnflag"),
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(layout, "ROWS_PER_FILE", 100, raising=False)
    monkeypatch.setattr(layouts, "fresh_folder", lambda spark, label: f"{folder}/{label}")
    found = layouts.layout_changed_keys(spark, folder).collect()
    assert all(r[2] and r[3] for r in found) and len(found) == 3
    sizes = spark.read.parquet(f"{folder}/changed-keys").groupBy(F.col("_metadata.file_name")).count()
    assert sizes.agg(F.sum("count")).first()[0] == 8000
    assert sizes.agg(F.max("count")).first()[0] < 200
