from __future__ import annotations

import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators.schema import SchemaMismatch
from millrace.sources import files
from millrace.sources.batches import BatchTable, first_fit
from millrace.sources.messages import READING_SCHEMA, message_stream, parse_messages
from millrace.sources.price_documents import SERIES, price_points, price_points_of_files, root_tag
from millrace.sources.readers import read_csv, read_json, read_table, stream_table, with_audit, with_provenance
from millrace.sources.writers import append, clone, drop_table, export_json, land_partitions, overwrite, seed_once, stream_to_files, truncate
from tests.conftest import rows

PUBLICATION = """<?xml version="1.0" encoding="UTF-8"?>
<!-- day ahead -->
<Publication_MarketDocument xmlns="urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3">
  <mRID>1</mRID>
  <TimeSeries>
    <currency_Unit.name>EUR</currency_Unit.name><price_Measure_Unit.name>MWH</price_Measure_Unit.name>
    <Period><timeInterval><start>2026-07-23T22:00Z</start><end>2026-07-24T22:00Z</end></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>1</position><price.amount>101.5</price.amount></Point>
      <Point><position>4</position><price.amount>-3.25</price.amount></Point>
    </Period>
    <Period><timeInterval><start>2026-07-24T22:00Z</start></timeInterval><resolution>PT60M</resolution>
      <Point><position>3</position><price.amount>7</price.amount></Point>
    </Period>
  </TimeSeries>
  <TimeSeries>
    <currency_Unit.name>PLN</currency_Unit.name>
    <Period><timeInterval><start>2026-07-24T22:00Z</start></timeInterval><resolution>P1D</resolution>
      <Point><position>2</position><price.amount>8</price.amount></Point>
    </Period>
  </TimeSeries>
</Publication_MarketDocument>"""
ACKNOWLEDGEMENT = '<Acknowledgement_MarketDocument xmlns="urn:x"><TimeSeries><Period/></TimeSeries></Acknowledgement_MarketDocument>'


def test_price_points(spark):
    df = spark.createDataFrame([("a", PUBLICATION), ("b", ACKNOWLEDGEMENT)], "name string, body string")
    assert [r[0] for r in df.select(root_tag("body")).collect()] == ["Publication_MarketDocument", "Acknowledgement_MarketDocument"]
    assert rows(price_points(df, "body", ["name"])) == [
        ("a", "2026-07-23T22:00:00Z", 101.5, "EUR", "MWH"),
        ("a", "2026-07-23T22:45:00Z", -3.25, "EUR", "MWH"),
        ("a", "2026-07-24T23:00:00Z", 8.0, "PLN", None),
        ("a", "2026-07-25T00:00:00Z", 7.0, "EUR", "MWH"),
    ]


def test_price_points_with_a_prefix(spark):
    prefixed = re.sub(r"<(/?)(?=[A-Zmcpterds])", r"<\1p:", PUBLICATION).replace("xmlns=", "xmlns:p=")
    assert "<p:Point>" in prefixed
    plain, other = (price_points(spark.createDataFrame([(t,)], "body string"), "body") for t in (PUBLICATION, prefixed))
    assert rows(plain) == rows(other) and plain.count() == 4


def test_messages(spark, folder):
    body = '{"event_id": "e1", "schema_version": 1, "site_id": "DC-PL-01", "consumption_kwh": 12.5, "pue": "x"}'
    envelopes = spark.createDataFrame(
        [(bytearray(body, "utf-8"), 3, 7, dt.datetime(2026, 1, 1)), (bytearray(b"junk"), 0, 8, dt.datetime(2026, 1, 1))],
        "value binary, partition int, offset bigint, timestamp timestamp",
    )
    overwrite(envelopes, f"{folder}/log")
    for _ in range(2):
        stream = message_stream(spark, {}, fmt="parquet", path=f"{folder}/log")
        stream_to_files(parse_messages(stream, READING_SCHEMA), f"{folder}/t", f"{folder}/c").awaitTermination()
    got = read_table(spark, f"{folder}/t").select("event_id", "site_id", "consumption_kwh", "pue", "partition", "offset")
    assert rows(got) == [(None, None, None, None, 0, 8), ("e1", "DC-PL-01", 12.5, None, 3, 7)]


def test_csv_provenance_and_audit(spark, folder):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, v string").coalesce(1).write.option("header", True).csv(f"{folder}/c")
    df = read_csv(spark, f"{folder}/c")
    assert df.dtypes == [("id", "int"), ("v", "string")]
    audited = with_audit(with_provenance(df), dt.datetime(2026, 1, 2, 3)).first()
    assert audited.source_file.endswith(".csv") and audited.source_path.startswith("file:")
    assert (audited.ingestion_ts, audited.load_date) == (dt.datetime(2026, 1, 2, 3), dt.date(2026, 1, 2))


def test_landing_a_slice_again_replaces_only_that_slice(spark, folder):
    schema = "zone string, day string, price double"
    land_partitions(spark.createDataFrame([("PL", "d1", 1.0), ("PL", "d2", 2.0)], schema), folder, ["zone", "day"])
    land_partitions(spark.createDataFrame([("PL", "d2", 3.0)], schema), folder, ["zone", "day"])
    assert rows(spark.read.schema(schema).json(folder).select("zone", "day", "price")) == [("PL", "d1", 1.0), ("PL", "d2", 3.0)]


def test_seed_clone_truncate(spark, folder):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert seed_once(df, f"{folder}/t") and not seed_once(df, f"{folder}/t")
    clone(spark, f"{folder}/t", f"{folder}/u")
    truncate(spark, f"{folder}/t")
    assert (read_table(spark, f"{folder}/t").count(), read_table(spark, f"{folder}/u").count()) == (0, 2)
    assert seed_once(df, f"{folder}/t")


def test_batches_are_overwritten_by_their_replay(spark, folder):
    table = BatchTable(spark, folder)
    assert not table.exists()
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    table.write(first, "r", 0)
    assert rows(table.write(first, "r", 0)) == [(1, "a")]
    table.write(spark.createDataFrame([(2, 7)], "k int, extra int"), "r", 1)
    table.write(first, "other", 0)
    assert table.exists() and rows(table.read().select("k", "v", "extra")) == [(1, "a", None), (1, "a", None), (2, None, 7)]
    table.remove("r", 1)
    assert table.read().count() == 2
    table.replace(spark.createDataFrame([(5, "z")], "k int, v string"))
    assert rows(table.read()) == [(5, "z")]


def test_small_batches_are_packed(spark, folder):
    table = BatchTable(spark, folder)
    for k in range(60):
        table.write(spark.range(k * 10, k * 10 + 10).selectExpr("id", "string(id) as v"), "r", k)
    before, bytes_before = rows(table.read()), files.size(spark, f"{folder}/stream_run=r")
    target = 20_000
    table.pack(target)
    left = [n for n in files.names(spark, f"{folder}/stream_run=r")]
    parts = [f for n in left for f in files.sizes(spark, f"{folder}/stream_run=r/{n}")]
    assert len(parts) <= -(-bytes_before // target) + 1 and max(size for _, size in parts) < 2 * target
    assert rows(table.read()) == before and table.exists()
    assert table.pack(target) == 0  # what is packed stays
    with pytest.raises(ValueError, match="packed already"):
        table.write(spark.range(1).selectExpr("id", "string(id) as v"), "r", 7)
    table.write(spark.range(600, 610).selectExpr("id", "string(id) as v", "id as extra"), "r", 60)
    assert table.read().count() == 610 and table.read().filter("extra is null").count() == 600
    table.pack(target)
    assert table.read().count() == 610 and table.read().filter("extra is null").count() == 600


def test_readers_see_every_row_once_whatever_is_packed(spark, folder):
    table, seen = BatchTable(spark, f"{folder}/t"), []

    def work(batch, number):
        seen.extend(r.id for r in batch.collect())

    def write(*numbers):
        for k in numbers:
            table.write(spark.range(k * 10, k * 10 + 10), "r", k)

    write(0, 1, 2)
    table.drain("copy", f"{folder}/c", work)
    write(3, 4, 5)
    assert table.pack() == 1  # the first three; the others are still to be read
    assert sum(n.startswith("stream_batch=") for n in files.names(spark, f"{folder}/t/stream_run=r")) == 3
    table.drain("copy", f"{folder}/c", work)
    table.pack()
    table.drain("copy", f"{folder}/c", work)
    assert sorted(seen) == list(range(60)) and sorted(r.id for r in table.read().collect()) == list(range(60))


def test_packing_goes_on_after_a_crash(spark, folder, monkeypatch):
    table = BatchTable(spark, folder)
    for k in range(5):
        table.write(spark.range(k * 10, k * 10 + 10), "r", k)
    delete = files.delete
    with monkeypatch.context() as broken:
        broken.setattr(files, "delete", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.pack()
    assert table.read().count() == 50  # packed, but the old folders are still there
    table.pack()
    assert table.read().count() == 50 and files.delete is delete
    assert [n for n in files.names(spark, f"{folder}/stream_run=r") if n.startswith("stream_batch=")] == ["stream_batch=000000000004"]


def test_first_fit_decreasing():
    sizes = [50, 30, 70, 20, 30, 100, 250]
    bins = first_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(7))
    assert [sum(sizes[i] for i in b) for b in bins] == [250, 100, 100, 100]


def test_appends_of_other_columns_are_refused_or_merged(spark, folder):
    overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), f"{folder}/t")
    wider = spark.createDataFrame([(2, "b", 3)], "k int, v string, extra int")
    with pytest.raises(SchemaMismatch):
        append(wider, f"{folder}/t")
    append(wider, f"{folder}/t", merge_schema=True)
    merged = spark.read.option("mergeSchema", True).parquet(f"{folder}/t")
    assert rows(merged.select("k", "v", "extra")) == [(1, "a", None), (2, "b", 3)]


def test_small_files(spark, folder):
    files.create_text(spark, f"{folder}/a/x.json", "żółć")
    assert files.read_text(spark, f"{folder}/a/x.json") == "żółć"
    assert files.names(spark, f"{folder}/missing") == [] and files.exists(spark, f"{folder}/a")
    with pytest.raises(Exception, match="exist"):
        files.create_text(spark, f"{folder}/a/x.json", "again")


@pytest.mark.parametrize("trigger", [{"availableNow": True}, {"once": True}, {"processingTime": "1 second"}])
def test_every_trigger_copies_the_table_once(spark, folder, trigger):
    overwrite(spark.range(5).toDF("id"), f"{folder}/t")
    stream = stream_table(spark, f"{folder}/t", "id bigint")
    query = stream_to_files(stream, f"{folder}/copy", f"{folder}/c", trigger=trigger)
    if "processingTime" in trigger:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
    assert read_table(spark, f"{folder}/copy").count() == 5


def test_values_json_and_drop(spark, folder):
    """Rows given inline, appended to a table, exported, and the table dropped."""
    values = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(id, label)")
    export_json(values, f"{folder}/json")
    assert rows(read_json(spark, f"{folder}/json", "id int, label string")) == [(1, "a"), (2, "b")]
    assert rows(read_json(spark, f"{folder}/json").select("id")) == [(1,), (2,)]
    values.createOrReplaceTempView("inline_values")
    assert read_table(spark, "inline_values").count() == 2
    drop_table(spark, "never_there")


def test_price_points_of_files(spark, folder):
    """Whole files give the rows of their text: with prefix, attributes, declaration, and of other kinds none."""
    prefixed = re.sub(r"<(/?)(?=[A-Za-z])", r"<\1ns:", PUBLICATION.split("?>")[-1]).replace("xmlns=", "xmlns:ns=")
    marked = PUBLICATION.replace(f"<{SERIES}>", f'<{SERIES} id="1">')
    spread = PUBLICATION.replace("><", ">\n  <")
    other = PUBLICATION.replace("Publication_MarketDocument", "Balancing_MarketDocument")
    documents = {"plain": PUBLICATION, "prefixed": prefixed, "marked": marked, "spread": spread, "other": other, "empty": "", "ack": "<Acknowledgement_MarketDocument/>"}
    for name, text in documents.items():
        (pathlib.Path(folder) / f"{name}.xml").write_text(text)
    got = price_points_of_files(spark, folder, "file").withColumn("file", F.regexp_extract("file", "([a-z]+).xml", 1))
    want = price_points(spark.createDataFrame(list(documents.items()), "file string, body string"), "body", ["file"])
    assert rows(got) == rows(want) and {r.file for r in got.collect()} == {"plain", "prefixed", "marked", "spread"}


def test_a_large_document_is_read_by_several_tasks(spark, folder):
    point = "".join(f"<Point><position>{k}</position><price.amount>{k}.5</price.amount></Point>" for k in range(1, 501))
    series = f"<{SERIES}><currency_Unit.name>EUR</currency_Unit.name><Period><timeInterval><start>2026-01-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>{point}</Period></{SERIES}>"
    (pathlib.Path(folder) / "a.xml").write_text(f"<Publication_MarketDocument>{series * 200}</Publication_MarketDocument>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        points = price_points_of_files(spark, folder).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in points.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(per_task) == 100_000 and len(per_task) >= 4 and max(per_task) < 50_000
