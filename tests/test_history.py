from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators.history import apply_changes, as_of_lookup, open_rows, seed_history, versions_of
from millrace.operators.metrics import star
from millrace.session import materialise
from tests.conftest import rows

D1, D2, D3 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)
SITES = "site_id string, site_name string, country string, bidding_zone string"


def _seed(spark, *sites):
    return seed_history(spark.createDataFrame(list(sites), SITES), surrogate="dc_key", order="site_id", effective=D1)


def _apply(dim, updates, at, **options):
    return apply_changes(
        dim, updates, keys=["site_id"], tracked=["site_name"], surrogate="dc_key", order="site_id", effective=at, **options
    )


def test_a_renamed_site_gets_a_second_version(spark):
    dim = _seed(spark, ("S-200", "North hall", "FR", "FR"), ("S-300", "South hall", "PL", "PL"))
    change = spark.createDataFrame([("S-300", "South hall B", "PL", "PL")], SITES)
    once = _apply(dim, change, D2)
    assert rows(versions_of(once, "site_id", "S-300").select("dc_key", "site_name", "valid_from", "valid_to", "is_current")) == [
        (2, "South hall", D1, D2, False),
        (3, "South hall B", D2, None, True),
    ]
    assert once.filter("site_id = 'S-200' and is_current").count() == 1
    assert rows(_apply(once, change, D3)) == rows(once)


def test_new_unchanged_null_and_untracked(spark):
    dim = _seed(spark, ("A", "a", "PL", "PL"), ("B", None, "PL", "PL"), ("C", "c", "PL", "PL"))
    updates = spark.createDataFrame(
        [("A", "a", "XX", "XX"), ("B", "b", "PL", "PL"), ("C", None, "PL", "PL"), ("D", "d", "DE", "DE_LU")], SITES
    )
    result = _apply(dim, updates, D2)
    assert rows(result.filter("site_id <> 'D'")) == rows(dim)
    assert rows(result.filter("site_id = 'D'").select("dc_key", "valid_from", "is_current")) == [(4, D2, True)]
    null_safe = _apply(dim, updates, D2, null_safe=True)
    assert null_safe.filter("not is_current").count() == 2


def test_three_changes_chain(spark):
    dim = _seed(spark, ("A", "one", "PL", "PL"))
    for name, at in (("two", D2), ("three", D3)):
        dim = _apply(dim, spark.createDataFrame([("A", name, "PL", "PL")], SITES), at)
    assert [(r.site_name, r.valid_from, r.valid_to) for r in versions_of(dim, "site_id", "A").collect()] == [
        ("one", D1, D2), ("two", D2, D3), ("three", D3, None),
    ]


def test_as_of_lookup_takes_the_version_in_force(spark):
    dim = _seed(spark, ("A", "one", "PL", "PL"))
    dim = _apply(dim, spark.createDataFrame([("A", "two", "PL", "PL")], SITES), D2)
    facts = spark.createDataFrame(
        [("A", D1 - dt.timedelta(days=1)), ("A", D1), ("A", D2 - dt.timedelta(seconds=1)), ("A", D2), ("A", D3), ("Z", D2)],
        "site_id string, at timestamp",
    )
    expected = [None, "one", "one", "two", "two", None]
    found = as_of_lookup(facts, dim, key="site_id", at="at", columns=["site_name"])
    assert [r.site_name for r in found.orderBy("site_id", "at").collect()] == expected


def test_a_site_spelled_two_ways_is_two_rows_and_the_star_takes_current_ones(spark):
    sites = spark.createDataFrame([("S-400", "East hal", "LT", "LT"), ("S-400", "East hall", "LT", "LT")], SITES)
    assert open_rows(sites, D1).count() == 2
    dim = _apply(_seed(spark, ("A", "one", "PL", "PL")), spark.createDataFrame([("A", "two", "PL", "PL")], SITES), D2)
    fact = spark.createDataFrame([("A", 1.0)], "site_id string, cost double")
    joined = star(fact, dim_site=dim)
    assert rows(joined.select("site_name", "cost")) == [("two", 1.0)]


def test_open_rows_keep_the_time_type(spark):
    df = open_rows(spark.range(1), D1, "timestamp_ntz")
    assert dict(df.dtypes)["valid_to"] == "timestamp_ntz"
    assert df.filter(F.col("valid_from") == F.lit(D1)).count() == 1


def test_the_sweep_agrees_with_the_join_for_a_hot_key_with_gaps(spark):
    """A third of facts and versions belong to one key; every third version ended early."""
    hour = F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(0, cast(id as int) % 500, 0, 0)")
    site = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, F.lit(None)).otherwise((F.col("id") % 17).cast("string"))
    facts = spark.range(3000).select("id", site.alias("site_id"), hour.alias("at"))
    begin = F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(0, cast(h as int), 0, 0)")
    versions = spark.range(0, 500, 5).withColumnRenamed("id", "h").select(
        F.explode(F.array(F.lit("hot"), F.lit("3"), F.lit("5"))).alias("site_id"),
        F.col("h").cast("string").alias("site_name"),
        begin.alias("valid_from"),
        F.when(F.col("h") < 480, begin + F.when(F.col("h") % 3 == 0, F.expr("interval 2 hours")).otherwise(F.expr("interval 5 hours"))).alias("valid_to"),
    ).filter("site_id <> '5' or valid_to is not null")
    versions = versions.filter("valid_to is not null or site_name = '495'")
    in_force = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    joined = facts.alias("f").join(versions.alias("v"), (F.col("f.site_id") == F.col("v.site_id")) & in_force, "left")
    plain = joined.select("id", "f.site_id", "at", "site_name")
    swept = as_of_lookup(facts, versions, key="site_id", at="at", columns=["site_name"])
    assert plain.count() == 3000
    assert rows(swept.select(plain.columns)) == rows(plain)
    assert plain.filter("site_name is not null").count() > 500


def test_the_default_clock_is_read_once(spark):
    dim = materialise(seed_history(spark.createDataFrame([("A", "one", "PL", "PL")], SITES), surrogate="dc_key", order="site_id"), "dim")
    dim = _apply(dim, spark.createDataFrame([("A", "two", "PL", "PL")], SITES), None)
    first, again = (sorted(dim.select("valid_from", "valid_to").collect()) for _ in range(2))
    assert first == again and first[0].valid_to == first[1].valid_from
    assert as_of_lookup(dim.select("site_id", F.col("valid_from").alias("at")), dim, key="site_id", at="at", columns=["site_name"]).dropna().count() == 2


def test_dates_and_times_are_compared_in_the_wider_type(spark):
    ten = dt.datetime(2026, 1, 1, 10)
    dim = spark.createDataFrame([("A", "v1", ten, None)], "k string, name string, valid_from timestamp, valid_to timestamp")
    facts = spark.sql("select 'A' as k, d from values (date'2026-01-01'), (date'2026-01-02'), (cast(null as date)) t(d)")
    assert rows(as_of_lookup(facts, dim, key="k", at="d", columns=["name"])) == [
        ("A", None, None), ("A", dt.date(2026, 1, 1), None), ("A", dt.date(2026, 1, 2), "v1"),
    ]
