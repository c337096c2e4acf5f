"""Energy shares by country and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.lookup import enrich, enrich_matched, unmatched
from millrace.operators.metrics import apply_filters, coverage, metric_query, top_k

# The columns of the study.
COLUMNS = (
    "country",
    "year",
    "iso_code",
    "gas_share_energy",
    "coal_share_energy",
    "hydro_share_energy",
    "nuclear_share_energy",
    "biofuel_share_energy",
    "solar_share_energy",
    "wind_share_energy",
    "other_renewables_share_energy",
    "renewables_share_energy",
    "fossil_share_energy",
    "low_carbon_share_energy",
    "gdp",
)
FIRST_YEAR = 2015


def countries_only(energy: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Study columns of real countries (they have a code) from the first year on."""
    return energy.select(*[c for c in COLUMNS if c in energy.columns]).filter(
        (F.col("year") >= first_year) & F.col("iso_code").isNotNull()
    )


def with_region(countries: DataFrame, regions: DataFrame) -> DataFrame:
    """Enriched table: only countries that have a region, GDP also in billions."""
    joined = enrich_matched(countries, regions, "iso_code")
    return joined.withColumn("gdp_billion_usd", F.col("gdp") / 1e9)


def without_region(countries: DataFrame, regions: DataFrame) -> DataFrame:
    known = regions.filter("region is not null")
    return unmatched(countries, known, "iso_code", ["country", "iso_code"])


def region_average_all(countries: DataFrame, regions: DataFrame, measure: str) -> DataFrame:
    """Average of a measure by region, countries without a region as one NULL group."""
    joined = enrich(countries, regions, "iso_code")
    return joined.groupBy("region").agg(F.avg(measure).alias(measure)).orderBy(F.desc_nulls_last(measure))


def region_average(enriched: DataFrame, measure: str, year: int) -> DataFrame:
    """Average of a measure by region in one year, highest first."""
    return metric_query(enriched, ["region"], {measure: F.avg(measure)}, ranges={"year": (year, year)}, order_by=measure)


def region_trend(enriched: DataFrame, measure: str, until: int | None) -> DataFrame:
    """Average of a measure by region and year, up to a year."""
    return metric_query(enriched, ["region", "year"], {measure: F.avg(measure)}, ranges={"year": (None, until)})


def detail(enriched: DataFrame, columns: list[str], year: int) -> DataFrame:
    return apply_filters(enriched, ranges={"year": (year, year)}).select(*columns)


def region_coverage(enriched: DataFrame, year: int, has_data: Column) -> DataFrame:
    """Countries per region, and those with an energy mix, in one year."""
    rows = apply_filters(enriched, equal={"year": year})
    return coverage(rows, ["region"], "country", has_data, "countries_total", "countries_with_energy_mix").orderBy(
        F.desc("countries_with_energy_mix"), "region"
    )


def top_countries(countries: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The k highest in the last year that has data."""
    last = countries.filter(F.col(measure).isNotNull()).agg(F.max("year")).scalar()
    return top_k(countries.filter(F.col("year") == last), measure, k, ["country"])
