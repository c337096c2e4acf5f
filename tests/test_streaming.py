from __future__ import annotations

import json
import pathlib

import pytest
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructType

from millrace.sources import files
from millrace.sources.batches import BatchTable
from millrace.sources.readers import stream_files
from millrace.spec import Rule
from millrace.streaming.cdc import apply_changes_stream, clean_stream, current
from millrace.streaming.ingest import SchemaMemory, ingest_json, ingestion_audit
from millrace.streaming.reload import ReloadMismatch, current_generation, safe_reload
from millrace.streaming.rescue import parse_with_rescue
from tests.conftest import rows

HINTS = StructType().add("id", LongType()).add("price", DoubleType())


def put(folder, name, *records):
    path = pathlib.Path(folder) / "landing"
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def run(spark, folder, table, **options):
    ingest_json(spark, f"{folder}/landing", table, f"{folder}/state", **options)


def test_second_run_adds_nothing_and_new_files_add_theirs(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", {"id": 1, "price": 1.5}, "", {"id": 2, "price": 2.5})
    for _ in range(2):
        run(spark, folder, table, hints=HINTS)
        assert table.read().count() == 2
    put(folder, "b.json", {"id": 3, "price": 3.5})
    run(spark, folder, table, hints=HINTS)
    assert rows(table.read().select("id", "price", "source_file")) == [(1, 1.5, "a.json"), (2, 2.5, "a.json"), (3, 3.5, "b.json")]
    assert rows(ingestion_audit(table.read(), ["source_file"]).select("source_file", "n_rows")) == [("a.json", 2), ("b.json", 1)]


def test_wrong_types_and_broken_lines_are_rescued(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", {"id": 1, "price": "12,5"}, {"id": 2, "price": None}, "{broken")
    run(spark, folder, table, hints=HINTS)
    assert rows(table.read().select("id", "price", "_rescued_data")) == [
        (None, None, '{"_line":"{broken"}'), (1, None, '{"price":"12,5"}'), (2, None, None),
    ]


def test_unknown_fields_widen_the_table(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", {"id": 1, "price": 1.0})
    run(spark, folder, table)
    put(folder, "b.json", {"id": 2, "price": 2.0, "zone": "PL", "ok": True, "n": 7, "share": 0.5}, {"id": 3, "n": None})
    run(spark, folder, table)
    got = table.read()
    assert {k: v for k, v in got.dtypes if k in ("zone", "ok", "n", "share", "id", "price")} == {
        "id": "bigint", "price": "double", "zone": "string", "ok": "boolean", "n": "bigint", "share": "double",
    }
    assert rows(got.select("id", "zone", "ok", "n", "_rescued_data")) == [(1, None, None, None, None), (2, "PL", True, 7, None), (3, None, None, None, None)]


def test_stop_mode_fails_once_then_goes_on(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", {"id": 1, "price": 1.0, "zone": "PL"})
    with pytest.raises(Exception, match="new fields"):
        run(spark, folder, table, hints=HINTS, on_new_fields="stop")
    assert not table.exists()
    assert SchemaMemory(spark, f"{folder}/state/schema").load().names == ["id", "price", "zone"]
    run(spark, folder, table, hints=HINTS, on_new_fields="stop")
    assert rows(table.read().select("id", "zone")) == [(1, "PL")]


def test_a_replayed_batch_is_not_added_twice(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", {"id": 1, "price": 1.0})
    run(spark, folder, table, hints=HINTS)
    # as after a crash between the table's commit and the checkpoint's
    for kept in pathlib.Path(f"{folder}/state/checkpoint/commits").iterdir():
        kept.unlink()
    run(spark, folder, table, hints=HINTS)
    assert table.read().count() == 1


def test_a_lost_checkpoint_repeats_files_but_loses_none(spark, folder):
    table = BatchTable(spark, f"{folder}/bronze")
    for i in range(3):
        put(folder, f"{i}.json", {"id": i, "price": 1.0})
    run(spark, folder, table, hints=HINTS, files_per_trigger=1)
    files.delete(spark, f"{folder}/state/checkpoint")
    put(folder, "new.json", {"id": 9, "price": 1.0})
    run(spark, folder, table, hints=HINTS, files_per_trigger=1)
    assert sorted(r.id for r in table.read().collect()) == [0, 0, 1, 1, 2, 2, 9]


def test_objects_with_ids_as_keys_stay_one_map(spark, folder):
    hints = StructType().add("id", LongType()).add("seen", MapType(StringType(), LongType()))
    table = BatchTable(spark, f"{folder}/bronze")
    put(folder, "a.json", *[{"id": i, "seen": {f"user-{i}-{k}": k for k in range(40)}} for i in range(30)])
    run(spark, folder, table, hints=hints)
    assert SchemaMemory(spark, f"{folder}/state/schema").load().names == ["id", "seen"]
    assert table.read().selectExpr("sum(size(seen))").first()[0] == 1200


def test_rescue_keeps_siblings_and_nested_values(spark):
    schema = StructType().add("a", LongType()).add("b", StringType())
    df = spark.createDataFrame([('{"a": "x", "b": "y"}',), ('{"a": 1, "c": {"d": [1]}}',), ('{"a": 1}',), ("[1]",)], "v string")
    assert rows(parse_with_rescue(df, "v", schema)) == [
        (None, None, '{"_line":"[1]"}'), (None, "y", '{"a":"x"}'), (1, None, None), (1, None, '{"c":"{\\"d\\":[1]}"}'),
    ]


CHANGES = StructType().add("id", StringType()).add("seq", LongType()).add("kwh", DoubleType()).add("pue", DoubleType())
DROP = [Rule("key", "id IS NOT NULL")]
FAIL = [Rule("pue_valid", "pue BETWEEN 1.0 AND 3.0")]


def changes(spark, folder, table, one_by_one=True):
    stream = stream_files(spark, f"{folder}/landing", CHANGES, files_per_trigger=1 if one_by_one else None)
    apply_changes_stream(clean_stream(stream, {"pue": "decimal(4,3)"}, DROP, FAIL), table, checkpoint=f"{folder}/c")


def test_change_capture_keeps_the_newest_whatever_the_order(spark, folder):
    table = BatchTable(spark, f"{folder}/t")
    put(folder, "1.json", {"id": "a", "seq": 2, "kwh": 2.0, "pue": 1.1}, {"id": None, "seq": 1, "pue": 9.0})
    put(folder, "2.json", {"id": "a", "seq": 1, "kwh": 1.0, "pue": 1.1}, {"id": "b", "seq": 1, "kwh": 5.0, "pue": 1.1})
    put(folder, "3.json", {"id": "b", "seq": 3, "kwh": 7.0, "pue": 1.1}, {"id": "b", "seq": 2, "kwh": 6.0, "pue": 1.1})
    for _ in range(2):
        changes(spark, folder, table)
        assert rows(current(table, ["id"], "seq").select("id", "seq", "kwh")) == [("a", 2, 2.0), ("b", 3, 7.0)]


def test_a_broken_domain_rule_stops_the_stream(spark, folder):
    table = BatchTable(spark, f"{folder}/t")
    put(folder, "1.json", {"id": "a", "seq": 1, "kwh": 1.0, "pue": 5.0})
    with pytest.raises(Exception, match="pue_valid"):
        changes(spark, folder, table, one_by_one=False)
    assert not table.exists()


def test_reload_switches_only_if_the_rows_are_the_same(spark, folder):
    put(folder, "a.json", {"id": 1, "price": 1.0}, {"id": 2, "price": 1.0})

    def ingest(generation):
        ingest_json(spark, f"{folder}/landing", BatchTable(spark, generation.table), generation.state, hints=HINTS)

    def read(generation):
        return BatchTable(spark, generation.table).read()

    root = f"{folder}/bronze"
    ingest(current_generation(spark, root))
    assert safe_reload(spark, root, ingest, read) == (2, 2)
    assert current_generation(spark, root).number == 1
    put(folder, "b.json", {"id": 3, "price": 1.0})
    with pytest.raises(ReloadMismatch):
        safe_reload(spark, root, ingest, read)
    assert current_generation(spark, root).number == 1
    assert safe_reload(spark, root, ingest, read, same_rows=False) == (2, 3)
