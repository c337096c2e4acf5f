"""Hourly cost fact, dimensions and dashboard questions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from millrace.functions.calendar import calendar
from millrace.operators.history import current_rows
from millrace.operators.metrics import filter_values, star
from millrace.operators.timejoin import fill_rate, hourly_fact, time_bucket_join
from millrace.plans import dashboard
from millrace.plans.cube import Cube, widget
from millrace.plans.medallion import Lakehouse, datacenter_snapshot, full_refresh, incremental_refresh
from millrace.session import fresh_folder, materialise
from millrace.sources.readers import read_json, read_table, stream_files
from millrace.sources.writers import export_json, insert_overwrite, land_partitions
from workload.inputs import (
    QUARTER_PRICES_SQL,
    READINGS_SQL,
    fact,
    fact_sql,
    prices,
    quarter_prices,
    readings,
)
from workload.registry import case, half_up, units

FACT_COLUMNS = f"""site_id, bidding_zone, strftime(date, '%Y-%m-%d') as date, hour,
    {units("kwh_u", 2)} as avg_consumption_kwh, {units("kw_u", 2)} as avg_power_kw,
    {units("pue_u", 3)} as avg_pue, {units("cost_u", 2)} as cost_per_hour"""

FACT_TYPES = {
    "site_id": "string",
    "bidding_zone": "string",
    "date": "date",
    "hour": "int",
    "consumption_kwh": "decimal(10,4)",
    "avg_power_kw": "decimal(10,2)",
    "pue": "decimal(4,3)",
    "cost_per_hour": "decimal(10,2)",
}


@case(fact_sql() + f"select {FACT_COLUMNS} from fact")
def hourly_cost_fact(spark, sf):
    return fact(spark, sf)


@case(fact_sql(QUARTER_PRICES_SQL) + f"select {FACT_COLUMNS} from fact")
def hourly_cost_fact_quarter_prices(spark, sf):
    return hourly_fact(readings(spark, sf), quarter_prices(spark, sf))


@case(
    fact_sql().replace(half_up("sum(kwh_u)", 4, "count(kwh_u)", 2), half_up("sum(kwh_u)", 4, "count(kwh_u)", 4))
    + f"""select site_id, bidding_zone, strftime(date, '%Y-%m-%d') as date, hour, {units("kwh_u", 4)} as consumption_kwh,
    {units("kw_u", 2)} as avg_power_kw, {units("pue_u", 3)} as pue, {units("cost_u", 2)} as cost_per_hour from fact"""
)
def hourly_cost_fact_stored_types(spark, sf):
    """The fact inserted into a table with declared types."""
    return _stored_fact(spark, sf)


def _stored_fact(spark, sf):
    path = fresh_folder(spark, "fact")
    rows = hourly_fact(readings(spark, sf), prices(spark, sf), energy_digits=4)
    renamed = rows.withColumnsRenamed({"avg_consumption_kwh": "consumption_kwh", "avg_pue": "pue"})
    insert_overwrite(renamed, path, FACT_TYPES)
    return read_table(spark, path)


@case(
    f"""with {READINGS_SQL}, {QUARTER_PRICES_SQL}
    select cast(event_id as varchar) as event_id, site_id, {units("price_u", 2)} as price
    from readings r left join prices p on r.hour_ts = date_trunc('hour', p.ts) and r.bidding_zone = p.bidding_zone"""
)
def time_bucket_join_rows(spark, sf):
    joined = time_bucket_join(readings(spark, sf), quarter_prices(spark, sf))
    return joined.select("event_id", "site_id", "price")


@case(
    f"""with {READINGS_SQL}, {QUARTER_PRICES_SQL},
    hourly as (select bidding_zone, date_trunc('hour', ts) as ts, {half_up("sum(price_u)", 2, "count(price_u)", 6)} as price_u
               from prices group by all)
    select cast(event_id as varchar) as event_id, site_id, {units("price_u", 6)} as price
    from readings r left join hourly p on r.hour_ts = p.ts and r.bidding_zone = p.bidding_zone"""
)
def time_bucket_join_collapsed(spark, sf):
    joined = time_bucket_join(readings(spark, sf), quarter_prices(spark, sf), collapse=True)
    return joined.select("event_id", "site_id", "price")


@case(
    """select strftime(d, '%Y-%m-%d') as date, cast(month(d) as int) as month, cast(day(d) as int) as day,
           cast(weekofyear(d) as int) as week, cast(year(d) as int) as year,
           cast(dayofweek(d) + 1 as int) as day_of_week, strftime(d, '%A') as day_of_week_name,
           strftime(d, '%B') as month_name, cast(quarter(d) as int) as quarter,
           cast(dayofweek(d) in (0, 6) as varchar) as is_weekend
    from (select distinct cast(ts as date) as d from events)"""
)
def dim_date(spark, sf):
    return calendar(fact(spark, sf))


def _star(spark, sf):
    """The dates of the dimension come from the readings, so the fact is computed once."""
    return star(fact(spark, sf), calendar(readings(spark, sf).select(F.to_date("timestamp_utc").alias("date"))))


@case(
    fact_sql()
    + f"""select strftime(date, '%A') as day_of_week_name, {units("sum(cost_u)", 2)} as total_cost
    from fact group by 1"""
)
def star_cost_by_weekday(spark, sf):
    return dashboard.total_cost_by_weekday(_star(spark, sf))


@case(
    fact_sql()
    + f"""select {units("sum(cost_u)", 2)} as total_cost,
    {units(half_up("sum(pue_u)", 3, "count(pue_u)", 7), 7)} as avg_pue,
    strftime(max(date), '%Y-%m-%d') as latest_date, strftime(max(date), '%A') as latest_weekday from fact"""
)
def dashboard_metrics(spark, sf):
    return dashboard.counters(fact(spark, sf))


AVG_KWH_SQL = units(half_up("sum(kwh_u)", 2, "count(kwh_u)", 6), 6)


@case(fact_sql() + f"select site_id, hour, {AVG_KWH_SQL} as avg_kwh from fact group by site_id, hour")
def avg_kwh_by_site_hour(spark, sf):
    return dashboard.avg_kwh_by_site_hour(fact(spark, sf))


@case(
    fact_sql()
    + f"""select site_id, hour, {units(half_up("sum(pue_u)", 3, "count(pue_u)", 7), 7)} as avg_pue
    from fact group by site_id, hour"""
)
def avg_pue_by_site_hour(spark, sf):
    return dashboard.avg_pue_by_site_hour(fact(spark, sf))


@case(fact_sql() + f"select bidding_zone, {units('sum(cost_u)', 2)} as total_cost from fact group by 1")
def total_cost_by_zone(spark, sf):
    return dashboard.total_cost_by_zone(fact(spark, sf))


@case(
    fact_sql()
    + f"""select site_id, strftime(date, '%Y-%m-%d') as date,
    {units(half_up("sum(cost_u)", 2, "count(cost_u)", 6), 6)} as avg_cost from fact group by site_id, date"""
)
def avg_cost_by_site_date(spark, sf):
    return dashboard.avg_cost_by_site_date(fact(spark, sf))


@case(
    fact_sql()
    + f"""select site_id, hour, {AVG_KWH_SQL} as avg_kwh from fact
    where bidding_zone = 'PL' and strftime(date, '%A') = 'Monday' group by site_id, hour"""
)
def dashboard_filtered(spark, sf):
    chosen = {"bidding_zone": "PL", "day_of_week_name": "Monday", "date": None}
    return dashboard.avg_kwh_by_site_hour(_star(spark, sf), chosen)


@case(
    fact_sql()
    + """select bidding_zone, count(*) filter (strftime(date, '%A') = 'Monday') as n_rows from fact group by 1"""
)
def dashboard_filter_values(spark, sf):
    return filter_values(_star(spark, sf), "bidding_zone", F.col("day_of_week_name") == "Monday")


@case(
    f"""with {READINGS_SQL} select bidding_zone, strftime(ts, '%Y-%m') as month, {units("sum(kwh_u)", 4)} as total_kwh
    from readings group by 1, 2"""
)
def monthly_total_by_zone(spark, sf):
    return dashboard.monthly_kwh_by_zone(readings(spark, sf))


@case(
    fact_sql()
    + """select count(*) as total, count(cost_u) as with_cost, count(*) - count(cost_u) as null_cost from fact"""
)
def price_fill_rate(spark, sf):
    return fill_rate(fact(spark, sf), "cost_per_hour")


SNAPSHOT = dt.datetime(2024, 2, 1)


@case(
    f"""with {READINGS_SQL} select distinct site_id, site_name, country, bidding_zone,
    '2024-02-01 00:00:00.000000' as valid_from, cast(null as varchar) as valid_to, 'true' as is_current from readings"""
)
def dim_datacenter_snapshot(spark, sf):
    return datacenter_snapshot(readings(spark, sf), SNAPSHOT)


@case(
    fact_sql()
    + f"""select country, {units("sum(cost_u)", 2)} as total_cost
    from fact join (select distinct site_id, country from readings) using (site_id) group by country"""
)
def star_cost_by_country(spark, sf):
    sites = current_rows(datacenter_snapshot(readings(spark, sf), SNAPSHOT))
    rows = star(fact(spark, sf), dim_site=sites)
    return rows.groupBy("country").agg(F.sum("cost_per_hour").alias("total_cost"))


BRONZE_READING = (
    "event_id string, site_id string, site_name string, country string, bidding_zone string, "
    "timestamp_utc timestamp, consumption_kwh double, avg_power_kw double, pue double, "
    "reading_interval_s int, enqueued_ts timestamp, ingestion_ts timestamp"
)


def _bronze_prices(spark, sf):
    """Every price arrives twice, first as a forecast of 0, then final."""
    delivered = prices(spark, sf).withColumns(
        {
            "delivery": F.explode(F.array(F.lit(0), F.lit(5))),
            "currency": F.lit("EUR"),
            "unit": F.lit("MWH"),
            "source_file": F.lit("prices.json"),
        }
    )
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("delivery"), F.lit(0))
    return delivered.withColumns(
        {
            "price": F.when(F.col("delivery") == 5, F.col("price")).otherwise(F.lit(0).cast("decimal(10,2)")),
            "ingestion_ts": F.col("timestamp_utc") + minutes,
        }
    ).drop("delivery")


@case(fact_sql() + f"select {FACT_COLUMNS} from fact")
def medallion_full_refresh(spark, sf):
    """JSON bronze to gold."""
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    export_json(readings(spark, sf), house.path("bronze", "sensor_data"))
    bronze_readings = read_json(spark, house.path("bronze", "sensor_data"), BRONZE_READING)
    return full_refresh(house, _bronze_prices(spark, sf), bronze_readings, SNAPSHOT)


def _land_half(house, rows, number):
    """Readings of one half of the month as JSON files; those of three days are in both."""
    rows = rows.withColumn("day", F.to_date("timestamp_utc"))
    half = rows.filter("day < date'2024-01-17'") if number == 0 else rows.filter("day >= date'2024-01-14'")
    landing = house.path("bronze", "sensor_data")
    land_partitions(half.drop("day").withColumn("zone", F.col("bidding_zone")), f"{landing}/{number}", ["zone"])
    return half


def _incremental(spark, sf, house):
    stream = stream_files(spark, house.path("bronze", "sensor_data"), BRONZE_READING, files_per_trigger=None)
    return incremental_refresh(house, _bronze_prices(spark, sf), stream, SNAPSHOT)


@case(fact_sql() + f"select {FACT_COLUMNS} from fact")
def medallion_incremental_refresh(spark, sf):
    """Readings land in two halves of the month, the pipeline runs after each; some readings land twice."""
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    for number in (0, 1):
        _land_half(house, readings(spark, sf), number)
        fact_rows = _incremental(spark, sf, house)
    return fact_rows


def _full_then_incremental(spark, sf):
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    half = _land_half(house, readings(spark, sf), 0)
    full_refresh(house, _bronze_prices(spark, sf), half.drop("day"), SNAPSHOT)
    _land_half(house, readings(spark, sf), 1)
    return house, _incremental(spark, sf, house)


@case(fact_sql() + f"select {FACT_COLUMNS} from fact")
def medallion_full_then_incremental(spark, sf):
    """A full refresh over the first half, then the stream over both halves in the same folder."""
    return _full_then_incremental(spark, sf)[1]


@case(f"with {READINGS_SQL} select count(*) as n_rows, count(distinct event_id) as events, count(distinct site_id) as sites from readings")
def medallion_silver_events(spark, sf):
    """Silver after the same: one row for each event, one current row for each site."""
    house, _ = _full_then_incremental(spark, sf)
    sites = house.read("gold", "dim_datacenter").filter("is_current").agg(F.count(F.lit(1))).scalar()
    return house.read("silver", "sensor_data").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("events"), F.any_value(sites).alias("sites")
    )


@case(
    f"""with {READINGS_SQL} select distinct bidding_zone, strftime(ts, '%Y-%m-%d') as date from readings
    where cast(ts as date) >= date '2024-01-14'"""
)
def medallion_touched_slices(spark, sf):
    """Zones and dates whose files the second run wrote: those of the readings that were new to it."""
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    seen = []
    for number in (0, 1):
        _land_half(house, readings(spark, sf), number)
        _incremental(spark, sf, house)
        files = house.read("gold", "consumption_hourly").select("bidding_zone", "date", F.col("_metadata.file_name").alias("file"))
        seen.append(materialise(files.distinct(), "fact-files"))
    return seen[1].join(seen[0], "file", "left_anti").select("bidding_zone", "date").distinct()


# Zone names that look like numbers or are special in folder names.
ODD_ZONES = {"PL": "007", "DE_LU": "a:b/c", "FR": "01", "ES": "50% *", "CZ": ""}
ODD_ZONE_SQL = f"case bidding_zone {' '.join(f"when '{z}' then '{odd}'" for z, odd in ODD_ZONES.items())} end"


def _odd(df):
    zone = F.create_map(*[F.lit(v) for pair in ODD_ZONES.items() for v in pair])[F.col("bidding_zone")]
    return df.withColumn("bidding_zone", zone)


@case(fact_sql() + f"select {FACT_COLUMNS} from (select * replace ({ODD_ZONE_SQL} as bidding_zone) from fact)")
def medallion_odd_zones(spark, sf):
    """Zones keep their names and their type. Of the first half every reading first comes with a date a year
    before and then moves, which empties all slices of the first run."""
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    rows = _odd(readings(spark, sf))
    half = rows.filter("timestamp_utc < timestamp'2024-01-16 00:00:00'")
    early = half.withColumns({c: F.col(c) - F.expr("interval 1 year") for c in ("timestamp_utc", "ingestion_ts")})
    for number, part in enumerate((early, rows)):
        land_partitions(part.withColumn("day", F.to_date("timestamp_utc")), f"{house.path('bronze', 'sensor_data')}/{number}", ["day"])
        stream = stream_files(spark, house.path("bronze", "sensor_data"), BRONZE_READING, files_per_trigger=None)
        fact_rows = incremental_refresh(house, _odd(_bronze_prices(spark, sf)), stream, SNAPSHOT)
    return fact_rows


@case(
    """select * from (values ('consumption_kwh', 'decimal(10,4)'), ('cost_per_hour', 'decimal(10,2)'), ('date', 'date'),
        ('hour', 'int')) t(column_name, data_type) where (select count(*) from events) > 0"""
)
def stored_fact_types(spark, sf):
    """Types that the stored fact has, as its files say."""
    stored = _stored_fact(spark, sf)
    kinds = spark.createDataFrame(stored.dtypes, "column_name string, data_type string")
    return kinds.filter(F.col("column_name").isin("consumption_kwh", "cost_per_hour", "date", "hour"))


@case(
    fact_sql()
    + f"""select cast(row_number() over (order by total desc, bidding_zone) as int) as position, bidding_zone,
    {units("total", 2)} as total_cost from (select bidding_zone, sum(cost_u) as total from fact group by 1)"""
)
def zones_in_order_of_cost(spark, sf):
    """The order of a report as part of its rows."""
    totals = dashboard.total_cost_by_zone(fact(spark, sf))
    order = Window.orderBy(F.col("total_cost").desc(), "bidding_zone")  # a handful of zones
    return totals.select(F.row_number().over(order).alias("position"), "bidding_zone", "total_cost")


def _widget_sql(where: str) -> str:
    """All questions in long form: widget, two keys and a value."""
    cost, kwh, pue = (half_up(f"sum({c})", d, f"count({c})", d + 4) for c, d in (("cost_u", 2), ("kwh_u", 2), ("pue_u", 3)))
    rows = f"(select * from fact where {where})"
    return f"""
    select 'avg_kwh_by_site_hour' as widget, site_id as key1, hour::varchar as key2, {units(kwh, 6)} as value from {rows} group by all
    union all select 'avg_pue_by_site_hour', site_id, hour::varchar, {units(pue, 7)} from {rows} group by all
    union all select 'total_cost_by_zone', bidding_zone, null, {units("sum(cost_u)", 2)} from {rows} group by all
    union all select 'avg_cost_by_site_date', site_id, strftime(date, '%Y-%m-%d'), {units(cost, 6)} from {rows} group by all
    union all select 'total_cost_by_weekday', strftime(date, '%A'), null, {units("sum(cost_u)", 2)} from {rows} group by all
    union all select 'counters', strftime(max(date), '%Y-%m-%d'), strftime(max(date), '%A'), {units("sum(cost_u)", 2)} from {rows}
    union all select 'avg_pue', null, null, {units(pue, 7)} from {rows}"""


CHOICES = {"all": "true", "PL": "bidding_zone = 'PL'", "DE_LU": "bidding_zone = 'DE_LU'"}
CUBE_SQL = fact_sql() + " union all ".join(f"select '{name}' as choice, * from ({_widget_sql(where)})" for name, where in CHOICES.items())
KEYS = {
    "avg_kwh_by_site_hour": ("site_id", "hour", "avg_kwh"), "avg_pue_by_site_hour": ("site_id", "hour", "avg_pue"),
    "total_cost_by_zone": ("bidding_zone", None, "total_cost"), "avg_cost_by_site_date": ("site_id", "date", "avg_cost"),
    "total_cost_by_weekday": ("day_of_week_name", None, "total_cost"), "counters": ("latest_date", "latest_weekday", "total_cost"),
    "avg_pue": (None, None, "avg_pue"),
}


def _answers(cube):
    """Every widget under every choice of the zone filter, from the stored cube alone."""
    out = None
    for choice in CHOICES:
        for name, (first, second, value) in KEYS.items():
            rows = widget(cube, "counters" if name == "avg_pue" else name, {"bidding_zone": None if choice == "all" else choice})
            keys = [(F.col(c).cast("string") if c else F.lit(None).cast("string")).alias(f"key{k}") for k, c in ((1, first), (2, second))]
            rows = rows.select(F.lit(choice).alias("choice"), F.lit(name).alias("widget"), *keys, F.col(value).cast("double").alias("value"))
            out = rows if out is None else out.unionByName(rows)
    return out


@case(CUBE_SQL)
def dashboard_cube(spark, sf):
    """All widgets under three filter choices from one cube, which one scan of the fact filled."""
    cube = Cube(spark, fresh_folder(spark, "cube"))
    cube.rebuild(fact(spark, sf))
    return _answers(cube)


@case(CUBE_SQL)
def dashboard_cube_by_slices(spark, sf):
    """The cube of the fact's first twenty days, then only the months of the zones that later slices touch."""
    house = Lakehouse(spark, fresh_folder(spark, "lakehouse"))
    rows, stored = materialise(fact(spark, sf), "fact"), house.consumption()
    early, late = rows.filter("day(date) <= 20"), rows.filter("day(date) > 20")
    stored.replace(early, stored.counts(early))
    cube = Cube(spark, house.path("gold", "dashboard_cube"))
    cube.rebuild(stored.read())
    changed = stored.slices(late)
    stored.put(late, stored.counts(late), changed)
    cube.refresh(stored, changed)
    return _answers(cube)
