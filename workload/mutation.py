"""Duplicates, upserts, history and row numbers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators.changelog import apply_late_changes, build_history, overlapping
from millrace.operators.dedup import (
    distinct_per_group,
    drop_duplicates,
    duplicate_groups,
    duplicate_summary,
    keep_latest,
)
from millrace.operators.history import apply_changes, as_of_lookup, seed_history, versions_of
from millrace.operators.numbering import number_rows
from millrace.operators.upsert import upsert, upsert_sequenced
from millrace.session import fresh_folder, materialise
from millrace.sources.readers import read_table
from millrace.sources.writers import clone, overwrite, seed_once, truncate
from workload.inputs import table
from workload.registry import case, units

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


@case(
    f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, strftime(l_shipdate, {STAMP}) as l_shipdate
    from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc nulls last, {", ".join(c + " desc nulls last" for c in LINE_REST)}) = 1"""
)
def dedup_latest(spark, sf):
    return keep_latest(table(spark, sf, "lineitem"), LINE_KEYS, "l_shipdate")


@case(
    """select count(*) as total_rows, count(distinct (l_orderkey, l_linenumber)) as unique_key,
           count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicate_rows from lineitem"""
)
def duplicate_key_summary(spark, sf):
    return duplicate_summary(table(spark, sf, "lineitem"), LINE_KEYS)


@case("select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1")
def duplicate_key_groups(spark, sf):
    return duplicate_groups(table(spark, sf, "lineitem"), LINE_KEYS)


@case("select l_returnflag, count(distinct l_partkey) as n_parts from lineitem group by 1")
def distinct_parts_per_flag(spark, sf):
    return distinct_per_group(table(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", "n_parts")


@case(
    """select doc_id, lang, source, n_chars from documents
    qualify row_number() over (partition by text order by doc_id desc) = 1"""
)
def drop_duplicate_texts(spark, sf):
    # 256 bits stand for the text, which is neither shuffled nor sorted
    docs = table(spark, sf, "documents").withColumn("digest", F.sha2("text", 256)).drop("text")
    return drop_duplicates(docs, ["digest"]).drop("digest")


REPRICED_SQL = f"""with repriced as (
    select l_orderkey, sum(cast(round(l_extendedprice * 100) as bigint)) as total_u from lineitem group by 1),
updates as (
    select o_orderkey, o_custkey, o_orderstatus, {units("total_u", 2)} as o_totalprice, o_orderdate, o_orderpriority
    from orders join repriced on o_orderkey = l_orderkey),
target as (select * from orders where o_orderdate < date '1999-01-01')
"""
ORDER_COLUMNS = (
    f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {STAMP}) as o_orderdate, o_orderpriority"
)
UPSERT_SQL = (
    REPRICED_SQL
    + f"""select {ORDER_COLUMNS} from (
    select * from target where o_orderkey not in (select o_orderkey from updates) union all select * from updates)"""
)


def _booked(spark, sf):
    """The target: orders up to 1998."""
    return table(spark, sf, "orders").filter("o_orderdate < date'1999-01-01'")


def _repriced(spark, sf):
    """The batch: all orders that have lines, with the sum of their lines as price."""
    price = F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("o_totalprice")
    totals = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(price)
    orders = table(spark, sf, "orders")
    return orders.drop("o_totalprice").join(totals, "o_orderkey").select(*orders.columns)


@case(UPSERT_SQL)
def upsert_scd1(spark, sf):
    return upsert(_booked(spark, sf), _repriced(spark, sf), ["o_orderkey"])


@case(UPSERT_SQL)
def snapshot_table_merge(spark, sf):
    """Through stored tables: the merged one is written beside the old one."""
    old, new = fresh_folder(spark, "orders"), fresh_folder(spark, "orders-merged")
    overwrite(_booked(spark, sf), old)
    overwrite(upsert(read_table(spark, old), _repriced(spark, sf), ["o_orderkey"]), new)
    return read_table(spark, new)


@case(
    f"""with target as (
        select event_id, ts, user_id, event_type, value from events where ts < timestamp '2024-01-16'
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
    select event_id, strftime(ts, {STAMP}) as ts, user_id, event_type, value from (
        select * from target union all
        select event_id, ts, user_id, event_type, value from events)
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def upsert_sequenced_events(spark, sf):
    """All events against the state at mid month: some are late, some are new."""
    events = table(spark, sf, "events").drop("props")
    target = keep_latest(events.filter("ts < timestamp'2024-01-16 00:00:00'"), ["user_id"], "ts")
    return upsert_sequenced(target, events, ["user_id"], "ts")


SEED, CHANGE = dt.datetime(1995, 1, 1), dt.datetime(1998, 6, 1)
DIM_SQL = """with seed as (
    select row_number() over (order by c_custkey) as dc_key, c_custkey as site_id, c_name as site_name,
           c_mktsegment as country, c_nationkey as bidding_zone from customer),
updates as (
    select c_custkey as site_id, case when c_acctbal < 0 then c_name || ' (closed)' else c_name end as site_name,
           case when c_acctbal > 9000 then 'PREMIUM' else c_mktsegment end as country, c_nationkey as bidding_zone
    from customer
    union all select -1 - s_suppkey, s_name, 'SUPPLIER', s_nationkey from supplier),
opened as (
    select u.*, row_number() over (order by u.site_id) + (select max(dc_key) from seed) as dc_key
    from updates u left join seed s on s.site_id = u.site_id
    where s.site_id is null or s.site_name <> u.site_name),
dim as (
    select s.dc_key, s.site_id, s.site_name, s.country, s.bidding_zone, timestamp '1995-01-01' as valid_from,
           case when o.site_id is not null then timestamp '1998-06-01' end as valid_to,
           o.site_id is null as is_current
    from seed s left join opened o on o.site_id = s.site_id
    union all
    select dc_key, site_id, site_name, country, bidding_zone, timestamp '1998-06-01', null, true from opened)
"""
DIM_COLUMNS = f"""dc_key, site_id, site_name, country, bidding_zone, strftime(valid_from, {STAMP}) as valid_from,
    strftime(valid_to, {STAMP}) as valid_to, cast(is_current as varchar) as is_current"""


def _site_rows(spark, sf, name, country):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("site_id"),
        name.alias("site_name"),
        country.alias("country"),
        F.col("c_nationkey").alias("bidding_zone"),
    )


def _seeded(spark, sf):
    rows = _site_rows(spark, sf, F.col("c_name"), F.col("c_mktsegment"))
    seeded = seed_history(rows, surrogate="dc_key", order="site_id", effective=SEED, like="timestamp_ntz")
    return materialise(seeded, "dim")


def _changes(spark, sf):
    """All customers, some renamed, some with a change that is not tracked; suppliers are new."""
    closed = F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit(" (closed)"))).otherwise(F.col("c_name"))
    premium = F.when(F.col("c_acctbal") > 9000, "PREMIUM").otherwise(F.col("c_mktsegment"))
    suppliers = table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("site_id"),
        F.col("s_name").alias("site_name"),
        F.lit("SUPPLIER").alias("country"),
        F.col("s_nationkey").alias("bidding_zone"),
    )
    return _site_rows(spark, sf, closed, premium).unionByName(suppliers)


def _apply(dim, updates, effective):
    return apply_changes(
        dim, updates, keys=["site_id"], tracked=["site_name"], surrogate="dc_key", order="site_id", effective=effective
    )


def _dimension(spark, sf):
    return _apply(_seeded(spark, sf), _changes(spark, sf), CHANGE)


@case(DIM_SQL + f"select {DIM_COLUMNS} from dim")
def scd2_apply(spark, sf):
    return _dimension(spark, sf)


@case(DIM_SQL + f"select {DIM_COLUMNS} from dim")
def scd2_rerun_idempotent(spark, sf):
    """The same changes again, a year later, through a written table."""
    once = materialise(_dimension(spark, sf), "dim")
    return _apply(once, _changes(spark, sf), dt.datetime(1999, 6, 1))


@case(DIM_SQL + f"select {DIM_COLUMNS} from dim where country = 'BUILDING'")
def scd2_history_read(spark, sf):
    return versions_of(_dimension(spark, sf), "country", "BUILDING")


AS_OF_SQL = (
    DIM_SQL
    + """select o_orderkey, d.dc_key, d.site_name from orders o left join dim d on d.site_id = o.o_custkey
    and o.o_orderdate >= d.valid_from and (d.valid_to is null or o.o_orderdate < d.valid_to)"""
)


def _as_of(spark, sf, orders=None):
    orders = (orders or table(spark, sf, "orders")).withColumnRenamed("o_custkey", "site_id")
    found = as_of_lookup(orders, _dimension(spark, sf), key="site_id", at="o_orderdate", columns=["dc_key", "site_name"])
    return found.select("o_orderkey", "dc_key", "site_name")


@case(AS_OF_SQL)
def scd2_asof_join(spark, sf):
    return _as_of(spark, sf)


@case(AS_OF_SQL)
def scd2_asof_join_sweep(spark, sf):
    return _as_of(spark, sf)


@case("select o_orderkey, 100 + row_number() over (order by o_orderdate, o_orderkey) as order_no from orders")
def surrogate_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return number_rows(orders, "o_orderdate", "order_no", start=101).select("o_orderkey", "order_no")


@case("select count(*) as after_two_seeds from (select distinct user_id, event_type from events)")
def seed_only_once(spark, sf):
    path = fresh_folder(spark, "seed")
    rows = table(spark, sf, "events").select("user_id", "event_type")
    seed_once(rows, path)
    seed_once(rows.withColumn("user_id", F.col("user_id") + 1), path)
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("after_two_seeds"))


@case(
    """select 'clone' as table_name, count(*) as n_rows from orders
    union all select 'truncated', cast(0 as bigint)"""
)
def clone_and_truncate(spark, sf):
    origin, copy = fresh_folder(spark, "orders"), fresh_folder(spark, "orders-copy")
    overwrite(table(spark, sf, "orders"), origin)
    clone(spark, origin, copy)
    truncate(spark, origin)
    counts = [
        read_table(spark, path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, path in (("clone", copy), ("truncated", origin))
    ]
    return counts[0].unionByName(counts[1])


@case("select c_custkey, row_number() over (order by c_name, c_custkey) as name_no from customer")
def customers_numbered_by_name(spark, sf):
    customers = table(spark, sf, "customer").select("c_name", "c_custkey")
    return number_rows(customers, "c_name", "name_no").select("c_custkey", "name_no")


@case(
    DIM_SQL
    + """select o_orderkey, d.dc_key, d.site_name from orders o left join dim d on d.site_id = o.o_custkey
    and cast(o.o_orderdate as date) >= d.valid_from and (d.valid_to is null or cast(o.o_orderdate as date) < d.valid_to)"""
)
def scd2_asof_dates(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return _as_of(spark, sf, orders)


@case("select count(*) as facts, count(*) as with_version, cast(0 as bigint) as overlaps from customer")
def scd2_default_clock(spark, sf):
    """Two batches stamped by the clock: the moment of the change has exactly one version per site."""
    rows = _site_rows(spark, sf, F.col("c_name"), F.col("c_mktsegment"))
    dim = materialise(seed_history(rows, surrogate="dc_key", order="site_id"), "dim")
    renamed = rows.withColumn("site_name", F.concat("site_name", F.lit(" II")))
    dim = _apply(dim, renamed, None)
    facts = dim.filter("is_current").select("site_id", F.col("valid_from").alias("at"))
    found = as_of_lookup(facts, dim, key="site_id", at="at", columns=["dc_key", "valid_to"])
    closed = dim.filter("not is_current").select("site_id", F.col("valid_to").alias("end"))
    together = found.join(closed, "site_id")
    return together.agg(
        F.count(F.lit(1)).alias("facts"),
        F.count_if(F.col("dc_key").isNotNull() & F.col("valid_to").isNull()).alias("with_version"),
        F.count_if(F.col("end") != F.col("at")).alias("overlaps"),
    )


# What a customer's orders say about it: its priority from the date of an order on. An order that is
# finished and has no price above 50,000 ends the customer.
ORDER_LOG_SQL = f"""with entries as (
    select o_custkey, o_orderdate as since, o_orderpriority, o_orderstatus = 'F' and o_totalprice <= 50000 as gone
    from orders qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1),
states as (
    select *, case when gone then 'gone' else 'is ' || o_orderpriority end as state from entries),
runs as (
    select * from states
    qualify state is distinct from coalesce(lag(state) over (partition by o_custkey order by since), 'gone')),
versions as (
    select *, lead(since) over (partition by o_custkey order by since) as until from runs),
dim as (
    select o_custkey, o_orderpriority, since as valid_from, until as valid_to, until is null as is_current
    from versions where not gone)
"""
ORDER_VERSIONS_SQL = ORDER_LOG_SQL + f"""select o_custkey, o_orderpriority, strftime(valid_from, {STAMP}) as valid_from,
    strftime(valid_to, {STAMP}) as valid_to, cast(is_current as varchar) as is_current from dim"""


def _order_log(spark, sf):
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") <= 50000)
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", gone.alias("gone"))


LOG = {"keys": ["o_custkey"], "tracked": ["o_orderpriority"], "at": "o_orderdate", "sequence": ["o_orderkey"], "deleted": "gone"}


@case(ORDER_VERSIONS_SQL)
def scd2_change_log(spark, sf):
    """Versions of all customers from the whole log at once."""
    return build_history(_order_log(spark, sf), **LOG)


def _late_batches(spark, sf):
    """The log in four batches that share customers and times, the last orders first, each into the dimension before it."""
    log = _order_log(spark, sf)
    parts = [log.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == k) for k in range(3)]
    parts = [parts[0].filter("o_orderdate >= date'1997-01-01'"), parts[2], parts[1], parts[0].filter("o_orderdate < date'1997-01-01'")]
    columns = "c_key long, o_custkey long, o_orderpriority string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    dim, applied = spark.createDataFrame([], columns), log.limit(0)
    for part in parts:
        dim = materialise(apply_late_changes(dim, applied, part, surrogate="c_key", **LOG), "customers")
        applied = applied.unionByName(part)
    return dim


@case(ORDER_VERSIONS_SQL)
def scd2_late_changes(spark, sf):
    """The same in late batches: whatever the order of the batches, the versions are those of the whole log."""
    return _late_batches(spark, sf).drop("c_key")


@case(
    ORDER_LOG_SQL
    + """select count(*) as n_versions, count(*) as surrogates, cast(0 as bigint) as overlaps, count(*) filter (is_current) as open from dim"""
)
def scd2_late_sound(spark, sf):
    """Every version has a surrogate key of its own and none reaches into another."""
    dim = _late_batches(spark, sf)
    counts = dim.agg(F.count(F.lit(1)).alias("n_versions"), F.count_distinct("c_key").alias("surrogates"), F.count_if("is_current").alias("open"))
    return counts.withColumn("overlaps", overlapping(dim, ["o_custkey"]).agg(F.count(F.lit(1))).scalar())
