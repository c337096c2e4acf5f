from __future__ import annotations

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from millrace.plans import medallion
from millrace.plans.medallion import Lakehouse, full_refresh, incremental_refresh
from millrace.session import materialise
from millrace.sources import slices
from millrace.sources.readers import stream_files
from millrace.sources.slices import SliceTable
from tests.conftest import rows
from workload.gold import BRONZE_READING

NOON = dt.datetime(2026, 1, 5, 12)
AS_OF = dt.datetime(2026, 2, 1)


def reading(event, kwh, ts="2026-01-05T12:10:00Z", seen=0, zone="PL", interval=3600, pue=1.5):
    return {
        "event_id": event, "site_id": f"S-{zone}", "site_name": "Hall", "country": zone, "bidding_zone": zone, "timestamp_utc": ts,
        "consumption_kwh": kwh, "avg_power_kw": 1.0, "pue": pue, "reading_interval_s": interval,
        "enqueued_ts": ts, "ingestion_ts": f"2026-01-06T00:00:{seen:02d}Z",
    }


def land(folder, name, *records):
    path = pathlib.Path(folder) / "landing"
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(map(json.dumps, records)) + "\n")


def prices(spark, *values):
    data = [(zone, ts, float(p), "EUR", "MWH", "f", AS_OF) for zone, ts, p in values or [("PL", NOON, 10)]]
    return spark.createDataFrame(
        data, "bidding_zone string, timestamp_utc timestamp, price double, currency string, unit string, source_file string, ingestion_ts timestamp"
    )


def bronze(spark, folder):
    return spark.read.schema(BRONZE_READING).json(f"{folder}/landing")


def stream(spark, folder):
    return stream_files(spark, f"{folder}/landing", BRONZE_READING, files_per_trigger=1)


def fact(rows_of):
    return rows(rows_of.selectExpr("bidding_zone", "string(date)", "hour", "double(avg_consumption_kwh)", "double(cost_per_hour)"))


def test_a_broken_rule_of_the_table_stops_both_paths(spark, folder):
    house = Lakehouse(spark, f"{folder}/house")
    land(folder, "a.json", reading("e1", 1.0, interval=0))
    with pytest.raises(Exception, match="interval_positive"):
        full_refresh(house, prices(spark), bronze(spark, folder), AS_OF)
    with pytest.raises(Exception, match="interval_positive"):
        incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    assert not house.readings().exists()


def test_both_paths_give_the_same_tables(spark, folder):
    one, two = Lakehouse(spark, f"{folder}/one"), Lakehouse(spark, f"{folder}/two")
    land(folder, "a.json", reading("e1", 2.0), reading("e2", 4.0, zone="FR"), reading("e1", 3.0, seen=2))
    first = incremental_refresh(two, prices(spark), stream(spark, folder), AS_OF)
    assert fact(first) == [("FR", "2026-01-05", 12, 4.0, None), ("PL", "2026-01-05", 12, 3.0, 0.03)]
    land(folder, "b.json", reading("e3", 5.0, ts="2026-01-07T01:00:00Z", seen=1))
    full = full_refresh(one, prices(spark), bronze(spark, folder), AS_OF)
    more = incremental_refresh(two, prices(spark), stream(spark, folder), AS_OF)
    assert fact(full) == fact(more)
    for layer, name in (("silver", "sensor_data"), ("silver", "datacenter"), ("gold", "dim_date")):
        a, b = one.read(layer, name), two.read(layer, name)
        assert sorted(a.dtypes) == sorted(b.dtypes)
        assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(a.columns)))
    # the stream goes on over what the full refresh left
    land(folder, "c.json", reading("e1", 9.0, seen=5))
    again = incremental_refresh(one, prices(spark), stream(spark, folder), AS_OF)
    assert ("PL", "2026-01-05", 12, 9.0, 0.09) in fact(again)
    assert one.read("silver", "sensor_data").count() == 3


def test_a_reading_that_moves_leaves_its_old_slice(spark, folder):
    house = Lakehouse(spark, f"{folder}/house")
    land(folder, "a.json", reading("e1", 2.0))
    incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    land(folder, "b.json", reading("e1", 2.0, ts="2026-01-09T08:00:00Z", seen=9))
    assert fact(incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)) == [("PL", "2026-01-09", 8, 2.0, None)]


def test_changed_prices_refresh_their_slices(spark, folder):
    house = Lakehouse(spark, f"{folder}/house")
    land(folder, "a.json", reading("e1", 2.0), reading("e2", 2.0, ts="2026-01-08T12:00:00Z"))
    incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)

    def files():
        return {r[0] for r in house.read("gold", "consumption_hourly").filter("date = '2026-01-08'").select("_metadata.file_path").collect()}

    before = files()
    later = incremental_refresh(house, prices(spark, ("PL", NOON, 50)), stream(spark, folder), AS_OF)
    assert fact(later) == [("PL", "2026-01-05", 12, 2.0, 0.1), ("PL", "2026-01-08", 12, 2.0, None)]
    assert files() == before


@pytest.mark.parametrize("zone", ["007", "01", "a:b", "a/b%c", "", "~", "ż *"])
def test_zones_keep_their_name_and_emptied_slices_go(spark, folder, zone):
    house = Lakehouse(spark, f"{folder}/house")
    land(folder, "a.json", reading("e1", 2.0, zone=zone), reading("e2", 3.0, zone="PL"))
    first = fact(incremental_refresh(house, prices(spark, (zone, NOON, 10)), stream(spark, folder), AS_OF))
    assert sorted(r[0] for r in first) == sorted([zone, "PL"])
    assert house.read("gold", "consumption_hourly").schema["bidding_zone"].dataType.simpleString() == "string"
    land(folder, "b.json", reading("e1", 2.0, zone="FR", seen=9))
    later = incremental_refresh(house, prices(spark, (zone, NOON, 10)), stream(spark, folder), AS_OF)
    assert fact(later) == [("FR", "2026-01-05", 12, 2.0, None), ("PL", "2026-01-05", 12, 3.0, None)]
    assert len(list(pathlib.Path(f"{folder}/house/gold/consumption_hourly").rglob("*.parquet"))) == 2


def test_a_run_reads_and_writes_only_the_slices_it_touches(spark, folder, monkeypatch):
    house = Lakehouse(spark, f"{folder}/house")
    days = [reading(f"e{d}", 1.0, ts=f"2026-01-{d:02d}T12:00:00Z") for d in range(1, 21)]
    land(folder, "a.json", *days)
    incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)

    def stored():
        return {str(p): p.stat().st_mtime_ns for layer in ("silver/sensor_data", "gold/consumption_hourly") for p in pathlib.Path(f"{folder}/house/{layer}").rglob("*.parquet")}

    before, opened = stored(), []
    plain = SliceTable._files
    monkeypatch.setattr(SliceTable, "_files", lambda self, *paths: opened.append(plain(self, *paths)) or opened[-1])
    land(folder, "b.json", reading("new", 5.0, ts="2026-01-07T12:30:00Z"), reading("e3", 4.0, ts="2026-01-09T12:00:00Z", seen=5))
    later = incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    kept = {p for p, t in before.items() if stored().get(p) == t}
    assert len(before) == 40 and len(kept) == 2 * (20 - 3)  # the 3rd, 7th and 9th
    silver = [df for df in opened if "event_id" in df.columns]
    assert [sorted(f.split("slice_date=")[1][:10] for f in df.inputFiles()) for df in silver] == [["2026-01-03", "2026-01-07", "2026-01-09"]]
    assert {r[1] for r in fact(later)} == {f"2026-01-{d:02d}" for d in range(1, 21) if d != 3}
    # a repeated batch changes nothing, neither rows nor index
    rows_before, index = rows(house.readings().read()), house.event_slices().read().count()
    batch = materialise(house.readings().read().filter("event_id in ('new', 'e3')"), "batch")
    merged, new, places = medallion._merged(house, batch)
    assert new.count() == 0 and index == 22
    house.readings().put(merged, house.readings().counts(merged), places)
    assert rows(house.readings().read()) == rows_before


def test_large_slices_are_several_files(spark, folder, monkeypatch):
    monkeypatch.setattr(slices, "ROWS_PER_FILE", 100)
    df = spark.range(1000).selectExpr("id", "case when id < 750 then 'hot' else 'z' || id % 5 end as z")
    table = SliceTable(spark, f"{folder}/t", df.schema, {"z": F.col("z")})
    table.replace(df, table.counts(df))
    files = [len(list(p.glob("*.parquet"))) for p in pathlib.Path(f"{folder}/t").iterdir() if p.is_dir()]
    assert max(files) > 1 and sum(files) < 20 and rows(table.read()) == rows(df)


def test_tasks_that_write_slices_have_even_loads(spark, folder, monkeypatch):
    monkeypatch.setattr(slices, "ROWS_PER_FILE", 100)
    df = spark.range(5000).selectExpr("id", "case when id < 1000 then 'hot' else 'z' || id % 40 end as z")
    table = SliceTable(spark, f"{folder}/t", df.schema, {"z": F.col("z")})
    table.replace(df, table.counts(df))
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1)
    loads = table.read().groupBy(task).count().agg(F.max("count"), F.sum("count")).first()
    assert loads[0] <= 200 and loads[1] == 5000
    late = spark.range(300).selectExpr("id", "'new ' || id % 3 as z")  # slices that counts does not name
    table.put(late, {("z0",): 1}, [])
    assert rows(table.read()) == rows(df.unionByName(late))


def test_a_batch_that_failed_half_way_is_merged_again(spark, folder, monkeypatch):
    house = Lakehouse(spark, f"{folder}/house")
    land(folder, "a.json", reading("e1", 2.0), reading("e2", 3.0, zone="FR"))
    with monkeypatch.context() as broken:
        broken.setattr(medallion, "_add_sites", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    assert house.event_slices().read().count() == 2  # the other steps were done
    again = incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    assert fact(again) == [("FR", "2026-01-05", 12, 3.0, None), ("PL", "2026-01-05", 12, 2.0, 0.02)]
    assert house.event_slices().read().count() == 2
    land(folder, "b.json", reading("e1", 2.0, ts="2026-01-09T08:00:00Z", seen=9))
    moved = incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    assert fact(moved) == [("FR", "2026-01-05", 12, 3.0, None), ("PL", "2026-01-09", 8, 2.0, None)]


def test_places_of_events_come_from_one_join_with_the_index(spark, folder, monkeypatch):
    house = Lakehouse(spark, f"{folder}/house")
    days = {"a": "05", "b": "06", "c": "07"}
    for seen, moves in enumerate([{"e1": "a", "e2": "a"}, {"e1": "b"}, {"e1": "c"}, {"e1": "a", "e2": "b", "e3": "c"}]):
        land(folder, f"{seen}.json", *[reading(e, 1.0, ts=f"2026-01-{days[d]}T12:00:00Z", seen=seen) for e, d in moves.items()])
        incremental_refresh(house, prices(spark), stream(spark, folder), AS_OF)
    index = house.event_slices().read()
    noted = [("e1", "2026-01-05"), ("e1", "2026-01-06"), ("e1", "2026-01-07"), ("e2", "2026-01-05"), ("e2", "2026-01-06"), ("e3", "2026-01-07")]
    assert rows(index.select("event_id", "slice_date")) == noted  # e1 came back to a slice it had been in
    assert rows(house.readings().read().selectExpr("event_id", "string(to_date(timestamp_utc))")) == [("e1", "2026-01-05"), ("e2", "2026-01-06"), ("e3", "2026-01-07")]
    written = []
    monkeypatch.setattr(medallion, "materialise", lambda df, label, **kw: written.append(label) or materialise(df, label, **kw))
    batch = house.readings().read().withColumn("timestamp_utc", F.col("timestamp_utc") + F.expr("interval 30 days"))
    merged, new, places = medallion._merged(house, materialise(batch, "batch"))
    assert written == ["places-of-events", "merged"] and merged.count() == 3
    assert rows(new.select("event_id", "slice_date")) == [("e1", "2026-02-04"), ("e2", "2026-02-05"), ("e3", "2026-02-06")]
    assert sorted(p["slice_date"] for p in places) == ["2026-01-05", "2026-01-06", "2026-01-07", "2026-02-04", "2026-02-05", "2026-02-06"]


def test_slices_are_named_without_python_workers_and_by_value(spark, folder):
    odd = [None, "", "~", "~null", "a b", "a+b", "50% *", "PL", "PL\n", "x.y_z-1", "ż/ó:", "a\\b"]
    df = spark.createDataFrame([(i, z) for i, z in enumerate(odd * 2)], "id int, z string")
    table = SliceTable(spark, f"{folder}/t", df.schema, {"z": F.col("z")})
    counts = table.counts(df)
    escaped = F.replace(F.replace(F.url_encode("z"), F.lit("%"), F.lit("~")), F.lit("*"), F.lit("~2A"))
    plain = df.select(F.when(F.col("z").isNull(), "~null").when(escaped == "", "~").otherwise(escaped))
    assert sorted(counts) == sorted({tuple(r) for r in plain.collect()}) and set(counts.values()) == {2}
    assert sorted(map(tuple, table.slices(df))) == sorted(counts)
    known = table.known([(*place, [n]) for place, n in counts.items()], "_n array<int>")
    assert {tuple(r)[:-1]: r["_n"][0] for r in known.collect()} == counts
    assert "RDD" not in known._jdf.queryExecution().executedPlan().toString()
    table.replace(df, counts)
    assert rows(table.read()) == rows(df)
