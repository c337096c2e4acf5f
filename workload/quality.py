"""Profiles, rules, gates, alerts, schema changes, policies."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.metrics import apply_filters
from millrace.operators.profile import column_groups, null_profile, range_profile, shape_profile, table_shape, value_profile
from millrace.operators.profile_store import ProfileStore
from millrace.operators.quality import (
    RuleViolation,
    check_table,
    expect_or_drop,
    expect_or_fail,
    gate_report,
    quarantine,
    rule_metrics,
    table_audit,
    volume_alert,
    volume_by_day,
)
from millrace.operators.policies import bind_policies, set_groups
from millrace.operators.schema import SchemaMismatch, add_column, drop_column, merge_append, rename_column
from millrace.operators.security import (
    REGIONAL_FILTER,
    RowPolicy,
    SITE_ID_MASK,
    column_mask,
    create_sql_function,
    drop_personal,
    row_filter,
)
from millrace.session import fresh_folder, materialise
from millrace.sources.slices import SliceTable
from millrace.sources.writers import append, overwrite
from millrace.spec import Rule, TableSpec
from workload.inputs import fact, fact_sql, table
from workload.registry import case, half_up, units

LABELLED = "documents left join labels using (doc_id)"


def _labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


@case(
    " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as nulls, cast(0 as bigint) as nans from {LABELLED}"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    )
)
def null_profile_documents(spark, sf):
    return null_profile(_labelled(spark, sf))


KINDS = {"doc_id": "numeric", "text": "string", "lang": "string", "source": "string", "n_chars": "numeric", "quality": "numeric", "toxic": "numeric"}


@case(" union all ".join(f"select '{c}' as column_name, '{kind}' as kind, count({c}) as n_values from {LABELLED}" for c, kind in KINDS.items()))
def values_by_column_kind(spark, sf):
    """Columns grouped by the kind of their type; how many values each has, in one pass."""
    rows = _labelled(spark, sf)
    kinds = [(c, kind) for kind, columns in column_groups(rows).items() for c in columns]
    counts = rows.agg(*[F.count(c).alias(c) for c, _ in kinds])
    lines = [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.col(c).alias("n_values")) for c, kind in kinds]
    return counts.select(F.inline(F.array(*lines)))


@case(
    " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as nulls, "
        f"{'count(*) filter (isnan(' + c + '))' if c == 'balance' else 'cast(0 as bigint)'} as nans "
        "from (select c_name, case when c_acctbal < 0 then 'nan'::double else c_acctbal end as balance from customer)"
        for c in ("c_name", "balance")
    )
)
def nan_profile_balances(spark, sf):
    balance = F.when(F.col("c_acctbal") < 0, float("nan")).otherwise(F.col("c_acctbal")).alias("balance")
    return null_profile(table(spark, sf, "customer").select("c_name", balance))


@case("select o_orderpriority as value, count(*) as n_rows from orders group by 1")
def value_profile_priority(spark, sf):
    return value_profile(table(spark, sf, "orders"), "o_orderpriority")


@case(
    r"""select regexp_extract(url, '^(https?)://', 1) as scheme, regexp_extract(url, '\.(com|org|net)/', 1) as suffix,
           regexp_extract(url, '[?#]', 0) as separator, count(*) as n_rows from pages group by 1, 2, 3"""
)
def shape_profile_urls(spark, sf):
    patterns = {"scheme": (r"^(https?)://", 1), "suffix": (r"\.(com|org|net)/", 1), "separator": (r"[?#]", 0)}
    return shape_profile(table(spark, sf, "pages"), "url", patterns)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@case(
    " union all ".join(
        f"select '{c}' as column_name, min({c}) + 0.0 as min_value, max({c}) + 0.0 as max_value from lineitem" for c in MEASURES
    )
)
def range_profile_lines(spark, sf):
    return range_profile(table(spark, sf, "lineitem"), MEASURES)


@case("select count(*) as n_rows, cast(5 as int) as n_columns from documents")
def table_shape_documents(spark, sf):
    return table_shape(table(spark, sf, "documents"))


@case(
    """select p_partkey, p_size, p_retailprice from part
    where p_size >= 10 and p_retailprice between 900 and 1500 and p_brand = 'Brand#4'"""
)
def open_range_filter(spark, sf):
    rows = apply_filters(
        table(spark, sf, "part"),
        equal={"p_brand": "Brand#4", "p_type": None},
        ranges={"p_size": (10, None), "p_retailprice": (900, 1500)},
    )
    return rows.select("p_partkey", "p_size", "p_retailprice")


LINE_RULES = [
    Rule("quantity_range", "l_quantity BETWEEN 1 AND 45"),
    Rule("discount_low", "l_discount <= 0.08"),
    Rule("taxed", "nullif(l_tax, 0.0) IS NOT NULL"),
]
HOLDS = ["l_quantity between 1 and 45", "l_discount <= 0.08", "nullif(l_tax, 0.0) is not null"]


@case(f"select l_orderkey, l_linenumber, l_quantity from lineitem where {' and '.join(HOLDS)}")
def expect_drop(spark, sf):
    kept = expect_or_drop(table(spark, sf, "lineitem"), LINE_RULES)
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@case("select l_returnflag, count(*) as n_rows from lineitem group by 1")
def expect_fail_passes(spark, sf):
    rules = [Rule("positive", "l_quantity > 0"), Rule("known_flag", "l_returnflag IN ('A', 'N', 'R')")]
    return expect_or_fail(table(spark, sf, "lineitem"), rules).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@case(
    f"""select rule, case when failed > 0 then 'stopped' else 'passed' end as outcome, failed from (
        {' union all '.join(
            f"select '{r.name}' as rule, count(*) - count(*) filter ({h}) as failed from lineitem" for r, h in zip(LINE_RULES, HOLDS))}
        union all select 'positive', count(*) filter (not l_quantity > 0) from lineitem)"""
)
def expect_fail_stops(spark, sf):
    """Each rule as one that must hold: whether the job stops, and for how many rows it would."""
    lines, out = table(spark, sf, "lineitem"), None
    for rule in [*LINE_RULES, Rule("positive", "l_quantity > 0")]:
        try:
            expect_or_fail(lines, [rule]).write.format("noop").mode("overwrite").save()
            outcome = "passed"
        except PySparkException as error:
            outcome = "stopped" if rule.name in str(error) else str(error)
        row = rule_metrics(lines, [rule]).select("rule", F.lit(outcome).alias("outcome"), "failed")
        out = row if out is None else out.unionByName(row)
    return out


@case(
    f"""with inside as (select count(*) as n from lineitem where {HOLDS[0]})
    select 'rows inside the rule' as batch, 'stored' as outcome, n as n_rows from inside union all
    select 'all rows', 'refused', n from inside"""
)
def rejected_insert(spark, sf):
    """A batch with rows outside a table's CHECK is refused as a whole and leaves the table as it was."""
    spec = TableSpec("lines", {"l_orderkey": "bigint", "l_quantity": "decimal(10,2)"}, not_null=("l_orderkey",), checks=(LINE_RULES[0],))
    path, lines, out = fresh_folder(spark, "lines"), table(spark, sf, "lineitem"), None
    for name, batch in (("rows inside the rule", expect_or_drop(lines, [LINE_RULES[0]])), ("all rows", lines)):
        try:
            check_table(batch, spec).write.mode("append").parquet(path)
            outcome = "stored"
        except RuleViolation:
            outcome = "refused"
        row = spark.read.parquet(path).agg(F.lit(name).alias("batch"), F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("n_rows"))
        row = materialise(row, "batch")
        out = row if out is None else out.unionByName(row)
    return out


@case(
    " union all ".join(
        f"select '{r.name}' as rule, count(*) filter ({h}) as passed, count(*) - count(*) filter ({h}) as failed from lineitem"
        for r, h in zip(LINE_RULES, HOLDS)
    )
)
def expect_metrics(spark, sf):
    return rule_metrics(table(spark, sf, "lineitem"), LINE_RULES)


@case(
    "select l_orderkey, l_linenumber, concat_ws(',', "
    + ", ".join(f"case when not coalesce({h}, false) then '{r.name}' end" for r, h in zip(LINE_RULES, HOLDS))
    + f") as violated_rules from lineitem where not ({' and '.join(HOLDS)})"
)
def constraint_violations(spark, sf):
    bad = quarantine(table(spark, sf, "lineitem"), LINE_RULES)
    return bad.select("l_orderkey", "l_linenumber", F.array_join("violated_rules", ",").alias("violated_rules"))


@case(
    """with bad as (
        select case when count(*) = 0 then 1 else 0 end as non_empty,
               count(*) - count(distinct (l_orderkey, l_linenumber)) as unique_keys,
               count(*) filter (l_orderkey is null or l_shipdate is null) as null_keys,
               count(*) filter (l_quantity < 1 or l_quantity > 45) as quantity_range,
               count(*) filter (l_discount < 0) as discount_range
        from lineitem)
    select check_name, cast(bad_rows as bigint) as bad_rows, case when bad_rows > 0 then 'FAIL' else 'PASS' end as status
    from (unpivot bad on non_empty, unique_keys, null_keys, quantity_range, discount_range
          into name check_name value bad_rows)"""
)
def dq_gate_report(spark, sf):
    return gate_report(
        table(spark, sf, "lineitem"),
        keys=["l_orderkey", "l_linenumber"],
        not_null=["l_orderkey", "l_shipdate"],
        ranges=[Rule("quantity_range", "l_quantity BETWEEN 1 AND 45"), Rule("discount_range", "l_discount >= 0")],
    )


def _by_day(spark, sf):
    return table(spark, sf, "events").select(F.to_date("ts").alias("day"))


@case(
    """select count(*) as rows_today, case when count(*) < 192 then 'TRIGGERED' else 'OK' end as status
    from events where cast(ts as date) = date '2024-01-15'"""
)
def volume_alert_one_day(spark, sf):
    return volume_alert(_by_day(spark, sf), "day", dt.date(2024, 1, 15), 192)


@case(
    """select count(*) as rows_today, case when count(*) < 192 then 'TRIGGERED' else 'OK' end as status
    from events where cast(ts as date) = (select max(cast(ts as date)) from events)"""
)
def volume_alert_today(spark, sf):
    """The events are moved in time so that the last of their days is today."""
    days = _by_day(spark, sf)
    moved = days.withColumn("last", days.agg(F.max("day")).scalar())
    return volume_alert(moved.select(F.date_add(F.current_date(), F.datediff("day", "last")).alias("day")), "day", None, 192)


@case(
    """with days as (select unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as day from events),
    limits as (select count(*) // count(distinct cast(ts as date)) as usual from events)
    select strftime(d.day, '%Y-%m-%d') as day, count(e.ts) as rows_today,
           case when count(e.ts) < usual then 'TRIGGERED' else 'OK' end as status
    from days d left join events e on cast(e.ts as date) = d.day, limits
    group by d.day, usual"""
)
def volume_alert_by_day(spark, sf):
    """All events; a day is short if it has less than the mean of the days."""
    days = _by_day(spark, sf)
    rows, covered = days.agg(F.count(F.lit(1)), F.count_distinct("day")).first()
    return volume_by_day(days, "day", rows // covered)


@case(
    f"""select 'lineitem' as table_name, count(*) as row_count, count(distinct (l_orderkey, l_linenumber)) as unique_keys,
           count(*) filter (l_tax is null) as null_values from lineitem
    union all select 'orders', count(*), count(distinct o_orderkey), count(*) filter (o_totalprice is null) from orders
    union all select 'documents', count(*), count(distinct doc_id), count(*) filter (quality is null) from {LABELLED}"""
)
def audit_union(spark, sf):
    parts = [
        table_audit(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], "l_tax"),
        table_audit(table(spark, sf, "orders"), "orders", ["o_orderkey"], "o_totalprice"),
        table_audit(_labelled(spark, sf), "documents", ["doc_id"], "quality"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


MERGED_SQL = """select doc_id, lang, cast(null as int) as quality from documents
    union all select doc_id, null, quality from labels"""


@case(MERGED_SQL)
def schema_merge_append(spark, sf):
    return merge_append(
        table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality")
    )


@case(MERGED_SQL)
def schema_merge_stored(spark, sf):
    """The same through a stored table: its first files lack the column that came later."""
    path = fresh_folder(spark, "documents")
    overwrite(table(spark, sf, "documents").select("doc_id", "lang"), path)
    append(table(spark, sf, "labels").select("doc_id", "quality"), path, merge_schema=True)
    return spark.read.option("mergeSchema", True).parquet(path)


@case(
    """select 'documents' as step, 'stored' as outcome, count(*) as n_rows from documents union all
    select 'labels', 'refused', count(*) from documents union all
    select 'labels, other types', 'stored', 2 * count(*) from documents union all
    select 'labels, as the table', 'stored', count(*) from labels"""
)
def schema_refused_append(spark, sf):
    """An append of other columns is refused and leaves the table; an overwrite may have any."""
    path, out = fresh_folder(spark, "documents"), None
    docs, labels = table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality")
    steps = {
        "documents": lambda: overwrite(docs, path),
        "labels": lambda: append(labels, path),
        "labels, other types": lambda: append(docs, path),
        "labels, as the table": lambda: overwrite(labels, path),
    }
    for step, run in steps.items():
        try:
            run()
            outcome = "stored"
        except SchemaMismatch:
            outcome = "refused"
        row = spark.read.parquet(path).agg(F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("n_rows"))
        row = materialise(row, "step")
        out = row if out is None else out.unionByName(row)
    return out


@case(
    """select o_orderkey, o_custkey, o_totalprice as price, cast(null as varchar) as comment, o_orderpriority
    from orders"""
)
def schema_column_changes(spark, sf):
    orders = drop_column(table(spark, sf, "orders"), "o_orderstatus").drop("o_orderdate")
    renamed = rename_column(orders, "o_totalprice", "price")
    return add_column(add_column(renamed, "comment", "string"), "comment", "string")


AVG_COST = units(half_up("sum(cost_u)", 2, "count(cost_u)", 6), 6)
MASKED = "case when site_id like 'DC-PL-%' then site_id else '**-**-**' end"


@case(fact_sql() + f"select bidding_zone, {AVG_COST} as avg_cost from fact where bidding_zone = 'PL' group by 1")
def row_filter_members(spark, sf):
    seen = row_filter(fact(spark, sf), "bidding_zone", [REGIONAL_FILTER], {"Poland", "admins"})
    return seen.groupBy("bidding_zone").agg(F.avg("cost_per_hour").alias("avg_cost"))


@case(
    fact_sql()
    + """select count(*) as all_rows, count(*) filter (bidding_zone = 'PL') as seen_by_members, cast(0 as bigint) as seen_by_others from fact"""
)
def row_filter_others(spark, sf):
    """What the same fact shows to members of both groups and to others."""
    rows = fact(spark, sf).select("bidding_zone")
    views = {
        "all_rows": rows,
        "seen_by_members": row_filter(rows, "bidding_zone", [REGIONAL_FILTER], {"Poland", "admins"}),
        "seen_by_others": row_filter(rows, "bidding_zone", [REGIONAL_FILTER], {"Poland"}),
    }
    parts = [view.withColumn("view", F.lit(name)) for name, view in views.items()]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.agg(*[F.count_if(F.col("view") == name).alias(name) for name in views])


@case(fact_sql() + f"select {MASKED} as site_id, bidding_zone, {AVG_COST} as avg_cost from fact group by 1, 2")
def column_mask_members(spark, sf):
    seen = column_mask(fact(spark, sf), "site_id", SITE_ID_MASK, {"Poland"})
    return seen.groupBy("site_id", "bidding_zone").agg(F.avg("cost_per_hour").alias("avg_cost"))


@case(fact_sql() + f"select {MASKED} as site_id, {AVG_COST} as avg_cost from fact group by 1")
def masked_group_avg(spark, sf):
    seen = column_mask(fact(spark, sf), "site_id", SITE_ID_MASK, {"Poland"})
    return seen.groupBy("site_id").agg(F.avg("cost_per_hour").alias("avg_cost"))


@case(fact_sql() + f"select site_id, {AVG_COST} as avg_cost from fact group by 1")
def unmasked_group_avg(spark, sf):
    seen = column_mask(fact(spark, sf), "site_id", SITE_ID_MASK, {"admins"})
    return seen.groupBy("site_id").agg(F.avg("cost_per_hour").alias("avg_cost"))


@case(fact_sql() + f"select {MASKED} as site_id, count(*) as n_rows from fact where bidding_zone in ('PL', 'FR') group by 1")
def sql_function_policies(spark, sf):
    create_sql_function(spark, "zone_visible", "zone", "BOOLEAN", "CASE WHEN zone = 'PL' OR zone = 'FR' THEN TRUE ELSE FALSE END")
    create_sql_function(spark, "site_masked", "site", "STRING", "CASE WHEN site LIKE 'DC-PL-%' THEN site ELSE '**-**-**' END")
    seen = fact(spark, sf).filter(F.expr("zone_visible(bidding_zone)"))
    return seen.groupBy(F.expr("site_masked(site_id)").alias("site_id")).agg(F.count(F.lit(1)).alias("n_rows"))


@case("select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def pii_drop(spark, sf):
    return drop_personal(table(spark, sf, "customer"), ["c_name", "c_phone", "c_address"])


@case(
    """select o_orderkey, strftime(o_orderdate + interval 30 day, '%Y-%m-%d') as due_date, floor(o_totalprice / 1000) as thousands,
           case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else 'pending' end as status_word,
           cast(quarter(o_orderdate) as int) as quarter
    from orders"""
)
def scalar_functions_orders(spark, sf):
    words = F.array(F.lit("open"), F.lit("filled"), F.lit("pending"))
    position = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_add("o_orderdate", 30).alias("due_date"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("thousands"),
        F.element_at(words, position).alias("status_word"),
        F.quarter("o_orderdate").alias("quarter"),
    )


POLICY_SQL = fact_sql() + "".join(
    f"""{' union all ' if k else ''}select '{who}' as reader, site_id, bidding_zone, count(*) as n_rows, {AVG_COST} as avg_cost
    from (select {site} as site_id, bidding_zone, cost_u from fact where {where}) group by all"""
    for k, (who, site, where) in enumerate([
        ("Poland,admins", MASKED, "bidding_zone = 'PL'"), ("Poland", MASKED, "false"), ("France", "site_id", "bidding_zone = 'FR'"),
    ])
)


def _policy_table(spark, sf):
    """The fact as a table of the catalog, in a folder of its own."""
    path, name = fresh_folder(spark, "fact"), f"consumption_{uuid.uuid4().hex[:12]}"
    fact(spark, sf).write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return name


FRANCE = RowPolicy(frozenset({"France"}), "FR")


@case(POLICY_SQL)
def bound_policies(spark, sf):
    """One query by the name of a view, under three sets of groups."""
    name = _policy_table(spark, sf)
    set_groups(spark, [])
    bind_policies(spark, f"{name}_seen", name, rows={"bidding_zone": [REGIONAL_FILTER, FRANCE]}, masks={"site_id": SITE_ID_MASK})
    query = f"SELECT site_id, bidding_zone, count(*) AS n_rows, avg(cost_per_hour) AS avg_cost FROM {name}_seen GROUP BY ALL"
    out = None
    for groups in (["Poland", "admins"], ["Poland"], ["France"]):
        set_groups(spark, groups)
        rows = materialise(spark.sql(query).select(F.lit(",".join(groups)).alias("reader"), "*"), "seen")
        out = rows if out is None else out.unionByName(rows)
    return out


@case(
    fact_sql()
    + """select count(*) filter (bidding_zone = 'PL') as seen, count(*) filter (bidding_zone = 'PL' and cost_u > 0) as dear,
    'false' as leaked from fact"""
)
def bound_policies_leak_nothing(spark, sf):
    """Predicates that fail on what they are shown find no hidden row to fail on, nor a site behind its mask."""
    name = _policy_table(spark, sf)
    set_groups(spark, ["Poland", "admins"])
    bind_policies(spark, f"{name}_seen", name, rows={"bidding_zone": [REGIONAL_FILTER]}, masks={"site_id": SITE_ID_MASK})
    tests = ["bidding_zone <> 'PL'", "site_id LIKE 'DC-FR%' OR site_id LIKE 'DC-ES%'", "hash(bidding_zone, cost_per_hour) IS NULL"]
    probes = " AND ".join(f"if({t}, raise_error(concat('leak: ', site_id)), true)" for t in tests)
    seen = spark.sql(f"SELECT count(*) AS seen, count_if(cost_per_hour > 0) AS dear FROM {name}_seen WHERE {probes}")
    try:
        return materialise(seen.withColumn("leaked", F.lit(False)), "seen")
    except Exception as error:
        return spark.createDataFrame([(0, 0, "leak:" in str(error))], "seen long, dear long, leaked boolean")


@case(
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as nulls, min({c})::double as least, max({c})::double as greatest,
        'true' as distinct_close, 'true' as median_close from events"""
        for c in ("event_id", "user_id", "value")
    )
)
def profile_by_slices(spark, sf):
    """A profile of events from stored states: those of the first half of the month, then of the slices that changed.

    Counts and bounds are exact; distinct values are within 6 % and the median's rank within 3 % of the real ones.
    """
    columns = ["event_id", "user_id", "value"]
    events = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), *columns)
    source = SliceTable(spark, fresh_folder(spark, "events"), events.schema, {"type": F.col("event_type"), "day": F.col("day")})
    early, late = events.filter("day < date'2024-01-16'"), events.filter("day >= date'2024-01-16'")
    source.replace(early, source.counts(early))
    store = ProfileStore(spark, fresh_folder(spark, "profile"), source, {"type": "event_type", "day": "day"}, columns)
    store.rebuild()
    counts, changed = source.counts(late), source.slices(late)
    source.put(late, counts, changed)
    store.refresh(changed)
    report = materialise(store.report([0.5]), "report")
    medians = {r.column_name: r.quantiles[0] for r in report.collect()}
    exact = events.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")
    ).select("e.*")
    median = F.create_map(*[F.lit(x) for pair in medians.items() for x in pair])[F.col("column_name")]
    exact = exact.groupBy("column_name").agg(F.count_distinct("v").alias("d"), F.avg((F.col("v") <= median).cast("double")).alias("rank"))
    return report.join(exact, "column_name").select(
        "column_name", "n_rows", "nulls", F.col("least").cast("double").alias("least"), F.col("greatest").cast("double").alias("greatest"),
        (F.abs(F.col("n_distinct") - F.col("d")) <= 0.06 * F.col("d")).alias("distinct_close"), (F.abs(F.col("rank") - 0.5) <= 0.03).alias("median_close"),
    )
