"""Reports by country and region. Nations play the countries, order values the energy shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.lookup import enrich, unmatched
from millrace.plans import energy_mix
from workload.inputs import table
from workload.registry import case, half_up, units

MEASURE = "renewables_share_energy"


def _energy(spark, sf):
    """One row per order; orders of low priority have no share."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("country"),
        F.year("o_orderdate").alias("year"),
        F.col("n_name").alias("iso_code"),
        F.when(F.col("o_orderpriority") != "5-LOW", price).alias(MEASURE),
        price.alias("gdp"),
    )


def _regions(spark, sf, without=None):
    """The lookup; where matches are to be missing, it lacks one region."""
    r = table(spark, sf, "region")
    if without:
        r = r.filter(F.col("r_name") != without)
    return table(spark, sf, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("iso_code"), F.col("r_name").alias("region")
    )


ENERGY_SQL = """with energy as (
    select c_name as country, cast(year(o_orderdate) as int) as year, n_name as iso_code,
           case when o_orderpriority <> '5-LOW' then cast(round(o_totalprice * 100) as bigint) end as share_u,
           cast(round(o_totalprice * 100) as bigint) as gdp_u
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    where year(o_orderdate) >= 1996),
regions as (select n_name as iso_code, r_name as region from nation join region on n_regionkey = r_regionkey)
"""
LACKING_SQL = ENERGY_SQL.rstrip()[:-1] + " where r_name <> 'EUROPE')\n"
AVG_SHARE = units(half_up("sum(share_u)", 2, "count(share_u)", 6), 6)


def _countries(spark, sf):
    return energy_mix.countries_only(_energy(spark, sf), 1996)


def _enriched(spark, sf):
    return energy_mix.with_region(_countries(spark, sf), _regions(spark, sf))


@case(
    LACKING_SQL
    + f"select region, {AVG_SHARE} as {MEASURE} from energy left join regions using (iso_code) group by region"
)
def region_avg(spark, sf):
    return energy_mix.region_average_all(_countries(spark, sf), _regions(spark, sf, "EUROPE"), MEASURE)


@case(
    ENERGY_SQL
    + f"""select region, year, {AVG_SHARE} as {MEASURE} from energy join regions using (iso_code)
    where year <= 2000 group by region, year"""
)
def region_year_avg(spark, sf):
    return energy_mix.region_trend(_enriched(spark, sf), MEASURE, 2000)


@case(
    ENERGY_SQL
    + f"select region, {AVG_SHARE} as {MEASURE} from energy join regions using (iso_code) where year = 1998 group by region"
)
def region_avg_one_year(spark, sf):
    return energy_mix.region_average(_enriched(spark, sf), MEASURE, 1998)


@case(
    ENERGY_SQL
    + f"""select country, cast(gdp_u as double) / 100 / 1e9 as gdp_billion_usd, {units("share_u", 2)} as {MEASURE}
    from energy join regions using (iso_code) where year = 1999"""
)
def detail_one_year(spark, sf):
    rows = energy_mix.with_region(_countries(spark, sf).withColumn("gdp", F.col("gdp").cast("double")), _regions(spark, sf))
    return energy_mix.detail(rows, ["country", "gdp_billion_usd", MEASURE], 1999)


@case(
    ENERGY_SQL
    + """select region, count(distinct country) as countries_total,
           count(distinct case when share_u is not null then country end) as countries_with_energy_mix
    from energy join regions using (iso_code) where year = 1997 group by region"""
)
def coverage_by_region(spark, sf):
    return energy_mix.region_coverage(_enriched(spark, sf), 1997, F.col(MEASURE).isNotNull())


@case(
    ENERGY_SQL
    + f"""select country, year, {units("sum(share_u)", 2)} as {MEASURE} from energy
    where year = (select max(year) from energy where share_u is not null)
    group by country, year order by sum(share_u) desc nulls last, country limit 10"""
)
def top10_latest_year(spark, sf):
    yearly = _countries(spark, sf).groupBy("country", "year").agg(F.sum(MEASURE).alias(MEASURE))
    return energy_mix.top_countries(yearly, MEASURE)


@case(LACKING_SQL + "select distinct country, iso_code from energy where iso_code not in (select iso_code from regions)")
def countries_without_region(spark, sf):
    return energy_mix.without_region(_countries(spark, sf), _regions(spark, sf, "EUROPE"))


@case(
    """select c_custkey, c_name, n_name, r_name from customer
    left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"""
)
def left_join_region(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = enrich(enrich(table(spark, sf, "customer"), nations, "c_nationkey"), regions, "n_regionkey")
    return joined.select("c_custkey", "c_name", "n_name", "r_name")


@case(
    """select distinct c_custkey, c_name from customer where c_custkey not in
    (select o_custkey from orders where o_orderdate < date '1995-02-01')"""
)
def unmatched_keys(spark, sf):
    january = table(spark, sf, "orders").filter("o_orderdate < date'1995-02-01'")
    buyers = january.select(F.col("o_custkey").alias("c_custkey"))
    return unmatched(table(spark, sf, "customer"), buyers, "c_custkey", ["c_custkey", "c_name"])
