from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.profile import column_groups, null_profile, table_shape
from millrace.operators.schema import SchemaMismatch, add_column, drop_column, merge_append, rename_column
from millrace.operators.security import (
    REGIONAL_FILTER,
    SITE_ID_MASK,
    column_mask,
    create_sql_function,
    drop_personal,
    row_filter,
)
from millrace.plans.medallion import EXPECTED_ROWS_PER_DAY, GATE_RANGES, PRICES, READING_FAIL
from millrace.sources.readers import read_table
from millrace.sources.writers import append, insert_overwrite, overwrite
from millrace.spec import Rule
from tests.conftest import rows

PUE = Rule("pue_valid", "pue BETWEEN 1.0 AND 3.0")
KWH = Rule("kwh_positive", "kwh >= 0")


@pytest.fixture
def readings(spark):
    data = [("a", 1.0, 5.0), ("b", 3.0, 0.0), ("c", 3.01, 1.0), ("d", 0.99, -1.0), ("e", None, 1.0)]
    return spark.createDataFrame(data, "id string, pue double, kwh double")


def test_drop_keeps_only_rows_where_all_rules_hold(readings):
    assert [r.id for r in q.expect_or_drop(readings, [PUE, KWH]).orderBy("id").collect()] == ["a", "b"]


def test_metrics_count_null_as_failed(readings):
    assert rows(q.rule_metrics(readings, [PUE, KWH])) == [("kwh_positive", 4, 1), ("pue_valid", 2, 3)]
    relaxed = Rule("pue_valid", PUE.predicate, null_ok=True)
    assert rows(q.rule_metrics(readings, [relaxed])) == [("pue_valid", 3, 2)]


def test_fail_stops_the_job_and_names_the_rule(readings):
    with pytest.raises(Exception, match="pue_valid"):
        q.expect_or_fail(readings, [PUE]).collect()
    assert q.expect_or_fail(readings.filter("id in ('a', 'b')"), [PUE, KWH]).count() == 2
    with pytest.raises(q.RuleViolation, match="pue_valid: 3 rows"):
        q.check_rules(readings, [PUE, KWH])


def test_dropped_rows_do_not_fail(readings):
    kept = q.expect_or_drop(readings, [Rule("known", "id in ('a', 'b')")])
    assert q.expect_or_fail(kept, [PUE]).count() == 2


def test_quarantine_names_all_broken_rules(readings):
    assert rows(q.quarantine(readings, [PUE, KWH]).select("id", "violated_rules")) == [
        ("c", ["pue_valid"]), ("d", ["pue_valid", "kwh_positive"]), ("e", ["pue_valid"]),
    ]


def test_gate_bounds_differ_from_pipeline_bounds(spark):
    df = spark.createDataFrame([("a", 2.5, 1.0)], "event_id string, pue double, consumption_kwh double")
    report = q.gate_report(df, keys=["event_id"], not_null=["event_id"], ranges=GATE_RANGES)
    assert {r.check_name: r.status for r in report.collect()} == {
        "non_empty": "PASS", "unique_keys": "PASS", "null_keys": "PASS", "out_of_range": "FAIL",
    }
    q.check_rules(df, READING_FAIL)
    with pytest.raises(q.RuleViolation, match="out_of_range"):
        q.require_gate(report)


def test_gate_sees_empty_duplicate_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    got = {r.check_name: r.bad_rows for r in q.gate_report(df, keys=["k"], not_null=["k"], ranges=[]).collect()}
    assert got == {"non_empty": 0, "unique_keys": 2, "null_keys": 2}
    empty = {r.check_name: r.status for r in q.gate_report(df.limit(0), keys=["k"], not_null=["k"], ranges=[]).collect()}
    assert empty == {"non_empty": "FAIL", "unique_keys": "PASS", "null_keys": "PASS"}


def test_table_rules_refuse_a_bad_insert_and_leave_the_table(spark, folder):
    def batch(price, zone="PL"):
        return spark.createDataFrame([(zone, dt.datetime(2026, 1, 1), price)], "bidding_zone string, timestamp_utc timestamp, price double").select(
            "*", *[F.lit(None).alias(c) for c in ("currency", "unit", "source_file", "ingestion_ts", "silver_processed_ts")]
        )

    path = f"{folder}/prices"
    overwrite(q.check_table(batch(100.0), PRICES), path)
    for bad in (batch(99999.0), batch(5.0, None), batch(None)):
        with pytest.raises(q.RuleViolation):
            append(q.check_table(bad, PRICES), path)
    append(q.check_table(batch(-1000.0), PRICES), path)
    assert read_table(spark, path).count() == 2


def test_volume_alert_both_ways(spark):
    day = dt.date(2026, 8, 21)
    df = spark.range(EXPECTED_ROWS_PER_DAY).select(F.lit(day).alias("date"))
    assert rows(q.volume_alert(df, "date", day, EXPECTED_ROWS_PER_DAY)) == [(192, "OK")]
    assert rows(q.volume_alert(df, "date", day + dt.timedelta(1), EXPECTED_ROWS_PER_DAY)) == [(0, "TRIGGERED")]
    gap = df.unionByName(spark.createDataFrame([(day + dt.timedelta(2),)], "date date"))
    assert [r.status for r in q.volume_by_day(gap, "date", 192).orderBy("date").collect()] == ["OK", "TRIGGERED", "TRIGGERED"]


def test_schema_enforcement_and_merge(spark, folder):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, label string")
    wider = spark.createDataFrame([(3, "c", 99)], "id bigint, label string, score int")
    overwrite(table, folder)
    with pytest.raises(SchemaMismatch):
        append(wider, folder)
    assert spark.read.parquet(folder).count() == 2
    append(wider, folder, merge_schema=True)
    merged = spark.read.option("mergeSchema", True).parquet(folder)
    assert rows(merged) == [(1, "a", None), (2, "b", None), (3, "c", 99)]
    assert rows(merge_append(table, wider)) == rows(merged)
    with pytest.raises(SchemaMismatch):
        merge_append(table, spark.createDataFrame([("x",)], "id string"))


def test_column_changes(spark):
    df = spark.createDataFrame([(1, "u")], "id int, unit string")
    added = add_column(add_column(df, "kw", "decimal(10,2)"), "kw", "string")
    assert dict(added.dtypes)["kw"] == "decimal(10,2)"
    assert rename_column(df, "unit", "energy_unit").columns == ["id", "energy_unit"]
    assert drop_column(df, "unit").columns == ["id"]
    for broken in (lambda: rename_column(df, "x", "y"), lambda: rename_column(df, "id", "unit"), lambda: drop_column(df, "x")):
        with pytest.raises(SchemaMismatch):
            broken()


def test_insert_overwrite_casts_to_the_stored_types(spark, folder):
    insert_overwrite(spark.createDataFrame([(1.23456,)], "kwh double"), folder, {"kwh": "decimal(10,4)"})
    assert rows(spark.read.parquet(folder))[0][0].as_tuple().exponent == -4
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        insert_overwrite(spark.createDataFrame([(1e9,)], "kwh double"), folder, {"kwh": "decimal(10,4)"})


def test_policies_for_every_group_set(spark):
    df = spark.createDataFrame([("PL", "DC-PL-01"), ("FR", "DC-FR-01"), (None, "DC-PL-01")], "zone string, site string")
    seen = {g: row_filter(df, "zone", [REGIONAL_FILTER], g).count() for g in (frozenset(), frozenset({"Poland"}), frozenset({"admins"}), frozenset({"Poland", "admins"}))}
    assert sorted(seen.values()) == [0, 0, 0, 1]
    assert seen[frozenset({"Poland", "admins"})] == 1
    masked = column_mask(df, "site", SITE_ID_MASK, {"Poland"})
    assert rows(masked.groupBy("site").count()) == [("**-**-**", 1), ("DC-PL-01", 2)]
    assert rows(column_mask(df, "site", SITE_ID_MASK, {"admins"})) == rows(df)
    assert drop_personal(df, ["site", "phone"]).columns == ["zone"]
    create_sql_function(spark, "only_pl", "zone", "BOOLEAN", "CASE WHEN zone = 'PL' THEN TRUE ELSE FALSE END")
    assert df.filter("only_pl(zone)").count() == 1


def test_profiles(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (None, 1.0, "x")], "a int, b double, c string")
    assert rows(null_profile(df)) == [("a", 1, 0), ("b", 0, 1), ("c", 1, 0)]
    assert column_groups(df) == {"string": ["c"], "numeric": ["a", "b"], "other": []}
    assert rows(table_shape(df)) == [(2, 3)]
