"""Metric queries: measures by dimensions under optional filters, over a star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.cleaning import optional_range


def star(fact: DataFrame, dim_date: DataFrame | None = None, dim_site: DataFrame | None = None) -> DataFrame:
    """The fact with calendar attributes by date and site attributes by ``site_id``.

    The site dimension is cut to its current rows; joining all versions would repeat facts.
    """
    out = fact
    if dim_date is not None:
        out = out.join(dim_date, "date", "left")
    if dim_site is not None:
        extra = [c for c in dim_site.columns if c not in fact.columns and c not in ("valid_from", "valid_to", "is_current")]
        out = out.join(dim_site.filter("is_current").select("site_id", *extra), "site_id", "left")
    return out


def apply_filters(
    df: DataFrame,
    equal: Mapping[str, object] | None = None,
    ranges: Mapping[str, tuple[object, object]] | None = None,
) -> DataFrame:
    """Equality and closed-range filters; a None value or bound filters nothing."""
    for name, value in (equal or {}).items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    for name, (low, high) in (ranges or {}).items():
        df = df.filter(optional_range(name, low, high))
    return df


def metric_query(
    df: DataFrame,
    dimensions: Sequence[str],
    measures: Mapping[str, Column],
    *,
    equal: Mapping[str, object] | None = None,
    ranges: Mapping[str, tuple[object, object]] | None = None,
    order_by: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Group the filtered rows by the dimensions and compute the named measures."""
    rows = apply_filters(df, equal, ranges)
    aggregates = [c.alias(n) for n, c in measures.items()]
    out = rows.groupBy(*dimensions).agg(*aggregates) if dimensions else rows.agg(*aggregates)
    if order_by:
        key = F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_last()
        out = out.orderBy(key, *[F.col(d).asc_nulls_last() for d in dimensions if d != order_by])
    return out


def filter_values(df: DataFrame, column: str, selected: Column | None = None) -> DataFrame:
    """The choices of a filter: each value with its row count under the other filters."""
    matching = F.count_if(selected) if selected is not None else F.count(F.lit(1))
    return df.groupBy(column).agg(matching.alias("n_rows"))


def top_k(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k rows with the highest measure, ties by the given columns."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)


def coverage(df: DataFrame, group: Sequence[str], entity: str, has_data: Column, total: str, covered: str) -> DataFrame:
    """Distinct entities per group, and those with at least one row that has data.

    Grouping by entity first needs one combined shuffle; two distinct counts side by
    side would multiply the rows instead.
    """
    per_entity = df.groupBy(*group, entity).agg(F.max(has_data).alias("_has"))
    return per_entity.groupBy(*group).agg(F.count(entity).alias(total), F.count_if(F.col("_has") & F.col(entity).isNotNull()).alias(covered))
