"""Cleaning of messy columns. Order lines play the incident records; an order is an incident."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import cleaning as c
from millrace.operators.spelling import nearest_spelling
from millrace.plans.incidents import clean_incidents, closed_case_report
from workload.inputs import table
from workload.registry import case, half_up, units

# The raw records, written once for both engines: every expression is valid in Spark and in DuckDB.
RAW = {
    "incident_id": "l_orderkey",
    "line": "l_linenumber",
    "address": "l_linestatus",
    "incident_datetime": """case when l_discount = 0.1 then 'unknown'
        when l_returnflag = 'A' then {iso} when l_returnflag = 'N' then {month_first}
        when l_linestatus = 'O' then {day_first} else {slashes} end""",
    "reported_online": """case l_linenumber when 1 then ' TRUE ' when 2 then 'no' when 3 then 'Yes'
        when 4 then '0' when 5 then '1' when 6 then 'False' else 'maybe' end""",
    "num_arrests": "case when l_tax = 0.08 then null else l_linenumber - 3 end",
    "property_loss_usd": """case when l_linestatus = 'F' then cast(l_extendedprice as {text}) || '.0'
        when l_returnflag = 'R' then '-' || cast(l_extendedprice as {text})
        when l_returnflag = 'A' then 'not known' else cast(l_extendedprice as {text}) end""",
    "case_status": """case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then ' CLOSED '
        when o_orderstatus = 'F' then 'Closed' when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then 'RESOLVED'
        when o_orderstatus = 'O' then 'open' when o_orderpriority = '2-HIGH' then 'pendng'
        when o_orderpriority = '3-MEDIUM' then 'Investgation' when o_orderpriority = '5-LOW' then null
        else 'reopened' end""",
    "resolution": """case o_orderpriority when '1-URGENT' then 'arres made' when '2-HIGH' then 'Arrest Made '
        when '3-MEDIUM' then 'WARNING' when '4-NOT SPECIFIED' then 'N/A' else 'dismissed' end""",
    "suspect_age": "cast(l_quantity * 3 as int) - 10",
    "victim_age": "case when l_quantity > 40 then null else cast(l_quantity as int) * 2 end",
    "suspect_gender": "case l_returnflag when 'A' then ' M ' when 'N' then 'female' else 'N/A' end",
    "victim_gender": "case l_linestatus when 'O' then 'F' else 'Other' end",
}
SPARK_WORDS = {
    "text": "string",
    "iso": "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')",
    "month_first": "date_format(l_shipdate, 'MM-dd-yyyy')",
    "day_first": "date_format(l_shipdate, 'dd-MM-yyyy')",
    "slashes": "date_format(l_shipdate, 'MM/dd/yyyy HH:mm')",
}
DUCK_WORDS = {
    "text": "varchar",
    "iso": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
    "month_first": "strftime(l_shipdate, '%m-%d-%Y')",
    "day_first": "strftime(l_shipdate, '%d-%m-%Y')",
    "slashes": "strftime(l_shipdate, '%m/%d/%Y %H:%M')",
}


def _raw(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    return lines.select(*[F.expr(e.format(**SPARK_WORDS)).alias(n) for n, e in RAW.items()])


RAW_SQL = (
    "raw as (select "
    + ", ".join(f"{e.format(**DUCK_WORDS)} as {n}" for n, e in RAW.items())
    + " from lineitem left join orders on l_orderkey = o_orderkey)"
)
WHEN_SQL = """case when regexp_full_match(incident_datetime, '\\d{4}-\\d\\d-\\d\\d .*') then try_strptime(incident_datetime, '%Y-%m-%d %H:%M:%S')
    when contains(incident_datetime, '/') then try_strptime(incident_datetime, '%m/%d/%Y %H:%M')
    else coalesce(try_strptime(incident_datetime, '%m-%d-%Y'), try_strptime(incident_datetime, '%d-%m-%Y')) end"""
LOSS_SQL = """try_cast(regexp_replace(property_loss_usd, '(\\.\\d+)\\.0$', '\\1') as double)"""
ONLINE_SQL = """case when lower(trim(reported_online)) in ('true', 'yes', '1') then 'true'
    when lower(trim(reported_online)) in ('false', 'no', '0') then 'false' end"""
STATUS_SQL = """case lower(trim(case_status)) when 'open' then 'Open' when 'closed' then 'Closed'
    when 'pending' then 'Pending' when 'pendng' then 'Pending' when 'under investigation' then 'Under Investigation'
    when 'investgation' then 'Under Investigation' when 'resolved' then 'Resolved' else 'Unknown' end"""
RESOLUTION_SQL = """case when lower(trim(resolution)) in ('arrest made', 'arres made') then 'Arrest Made'
    when lower(trim(resolution)) = 'no arrest' then 'No Arrest'
    when lower(trim(resolution)) in ('dismissed', 'case dismissed') then 'Case Dismissed'
    when lower(trim(resolution)) in ('warning', 'warning issued') then 'Warning Issued' else 'Unknown' end"""


def _band_sql(age: str) -> str:
    return f"""case when {age} is null or {age} < 0 or {age} > 120 then 'Unknown' when {age} < 18 then 'Minor'
    when {age} < 30 then 'Young Adult' when {age} < 60 then 'Adult' else 'Senior' end"""


def _gender_sql(gender: str) -> str:
    return f"""case when lower(trim({gender})) in ('male', 'm') then 'Male'
    when lower(trim({gender})) in ('female', 'f') then 'Female' when lower(trim({gender})) = 'other' then 'Other' end"""


CLEAN_SQL = f"""with {RAW_SQL}, one as (
    select * from raw qualify row_number() over (partition by incident_id order by line desc nulls last,
        incident_datetime desc nulls last, reported_online desc nulls last, num_arrests desc nulls last,
        property_loss_usd desc nulls last, case_status desc nulls last, resolution desc nulls last,
        suspect_age desc nulls last, victim_age desc nulls last, suspect_gender desc nulls last, victim_gender desc nulls last) = 1),
typed as (
    select incident_id, line, {WHEN_SQL} as incident_datetime, {ONLINE_SQL} as reported_online,
           cast(case when num_arrests is null then 0 when num_arrests < 0 then null else num_arrests end as int) as num_arrests,
           {LOSS_SQL} as loss, {STATUS_SQL} as case_status, {RESOLUTION_SQL} as resolution,
           {_gender_sql("suspect_gender")} as suspect_gender, {_gender_sql("victim_gender")} as victim_gender,
           case when num_arrests < 0 then 'NEEDS_REVIEW' end as num_arrests_flag,
           {_band_sql("suspect_age")} as suspect_age_group, {_band_sql("victim_age")} as victim_age_group
    from one),
clean as (
    select * exclude (loss), case when loss >= 0 then loss end as property_loss_usd,
           case when loss < 0 then 'NEEDS_REVIEW' end as property_loss_usd_flag from typed)
"""


@case(
    CLEAN_SQL
    + """select incident_id, line, strftime(incident_datetime, '%Y-%m-%d %H:%M:%S.%f') as incident_datetime, reported_online,
        num_arrests, property_loss_usd, case_status, resolution, suspect_gender, victim_gender, num_arrests_flag,
        suspect_age_group, victim_age_group, property_loss_usd_flag from clean"""
)
def clean_all_columns(spark, sf):
    return clean_incidents(_raw(spark, sf))


LOSS_CENTS = "cast(round(property_loss_usd * 100) as bigint)"


@case(
    CLEAN_SQL
    + f"""select suspect_gender, resolution, count(*) as incident_count,
        {units(half_up(f"sum({LOSS_CENTS})", 2, f"count({LOSS_CENTS})", 2), 2)} as avg_property_loss_usd
    from clean where case_status = 'Closed' and num_arrests > 0 group by 1, 2"""
)
def clean_summary(spark, sf):
    return closed_case_report(clean_incidents(_raw(spark, sf)))


@case(
    f"""with {RAW_SQL} select incident_id, line, incident_datetime as raw_text,
        strftime({WHEN_SQL}, '%Y-%m-%d %H:%M:%S.%f') as parsed from raw"""
)
def clean_dates(spark, sf):
    parsed = c.parse_timestamp("incident_datetime").alias("parsed")
    return _raw(spark, sf).select("incident_id", "line", F.col("incident_datetime").alias("raw_text"), parsed)


@case(
    f"""with {RAW_SQL}, n as (select *, {LOSS_SQL} as loss from raw)
    select incident_id, line, case when loss >= 0 then loss end as loss, case when loss < 0 then 'NEEDS_REVIEW' end as loss_flag,
        cast(case when suspect_age between 0 and 120 then suspect_age end as int) as age from n"""
)
def clean_numbers(spark, sf):
    repaired = _raw(spark, sf).withColumn("repaired", c.repair_number("property_loss_usd"))
    return repaired.select(
        "incident_id",
        "line",
        c.non_negative("repaired").alias("loss"),
        c.review_flag("repaired").alias("loss_flag"),
        c.in_range("suspect_age", 0, 120).alias("age"),
    )


@case(f"with {RAW_SQL} select reported_online as raw_text, {ONLINE_SQL} as parsed, count(*) as n_rows from raw group by 1, 2")
def clean_booleans(spark, sf):
    parsed = _raw(spark, sf).select(F.col("reported_online").alias("raw_text"), c.parse_boolean("reported_online").alias("parsed"))
    return parsed.groupBy("raw_text", "parsed").agg(F.count(F.lit(1)).alias("n_rows"))


@case(
    f"""with {RAW_SQL} select {STATUS_SQL} as case_status, {RESOLUTION_SQL} as resolution,
        {_gender_sql("suspect_gender")} as suspect_gender, count(*) as n_rows from raw group by 1, 2, 3"""
)
def clean_categories(spark, sf):
    cleaned = _raw(spark, sf).select(
        c.standardise("case_status", c.CASE_STATUS, "Unknown").alias("case_status"),
        c.standardise("resolution", c.RESOLUTION, "Unknown").alias("resolution"),
        c.standardise_gender("suspect_gender").alias("suspect_gender"),
    )
    return cleaned.groupBy(*cleaned.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@case(
    f"""with {RAW_SQL} select {_band_sql("suspect_age")} as suspect_age_group, {_band_sql("victim_age")} as victim_age_group,
        count(*) as n_rows from raw group by 1, 2"""
)
def age_bands(spark, sf):
    bands = _raw(spark, sf).select(
        c.band(c.in_range("suspect_age", 0, 120)).alias("suspect_age_group"),
        c.band(c.in_range("victim_age", 0, 120)).alias("victim_age_group"),
    )
    return bands.groupBy(*bands.columns).agg(F.count(F.lit(1)).alias("n_rows"))


# Nation names with up to three edits, by rules of the customer's number; and the names as they are.
MISSPELT_SQL = """misspelt as (
    select c_custkey, case c_custkey % 6
        when 0 then n
        when 1 then substr(n, 1, p - 1) || substr(n, p + 1)
        when 2 then substr(n, 1, p) || 'Q' || substr(n, p + 1)
        when 3 then substr(n, 1, p - 1) || 'J' || substr(n, p + 1, q) || substr(n, p + q + 2)
        when 4 then 'X' || substr(n, 1, p - 1) || 'Y' || substr(n, p + 1) || 'Z'
        else substr(n, 1, q + 1) end as written
    from (select c_custkey, upper(n_name) as n, cast(1 + c_custkey // 7 % length(n_name) as int) as p, cast(c_custkey // 11 % 5 as int) as q
          from customer join nation on c_nationkey = n_nationkey))"""


@case(
    f"""with {MISSPELT_SQL}, pairs as (
        select distinct written, upper(n_name) as word, levenshtein(written, upper(n_name)) as distance
        from (select distinct written from misspelt), nation),
    best as (select written, word, distance from pairs where distance <= 2
        qualify rank() over (partition by written order by distance) = 1),
    chosen as (select written, case when count(*) = 1 then min(word) end as corrected, min(distance)::int as distance from best group by 1)
    select c_custkey, m.written, corrected, distance from misspelt m left join chosen using (written)"""
)
def typos_corrected(spark, sf):
    """Misspelt nations to the one nearest name within two edits; ties and strangers stay open."""
    nations = table(spark, sf, "nation").select("n_nationkey", F.upper("n_name").alias("n"))
    rows = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.selectExpr("c_custkey", "n", "cast(1 + c_custkey div 7 % length(n) as int) as p", "cast(c_custkey div 11 % 5 as int) as q")
    written = """case c_custkey % 6 when 0 then n when 1 then substr(n, 1, p - 1) || substr(n, p + 1)
        when 2 then substr(n, 1, p) || 'Q' || substr(n, p + 1)
        when 3 then substr(n, 1, p - 1) || 'J' || substr(n, p + 1, q) || substr(n, p + q + 2)
        when 4 then 'X' || substr(n, 1, p - 1) || 'Y' || substr(n, p + 1) || 'Z' else substr(n, 1, q + 1) end as written"""
    misspelt = rows.selectExpr("c_custkey", written)
    near = nearest_spelling(misspelt, "written", nations, "n")
    return misspelt.join(near, F.col("written") == F.col("value"), "left").select("c_custkey", "written", "corrected", "distance")
