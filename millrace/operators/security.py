"""Row filters and column masks as data operators.

Open-source Spark has no group membership function, so the caller's groups are an
argument. Removing a filter or mask means using the base DataFrame.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class RowPolicy:
    """Members of all ``groups`` see rows whose column has ``value``; nobody sees anything else."""

    groups: frozenset[str]
    value: str

    def visible(self, column: Column, member_of: Collection[str]) -> Column:
        return column == F.lit(self.value) if self.groups <= set(member_of) else F.lit(False)


@dataclass(frozen=True)
class MaskPolicy:
    """Members of ``group`` see values like ``pattern``, all others masked; non-members see all."""

    group: str
    pattern: str
    mask: str

    def masked(self, column: Column, member_of: Collection[str]) -> Column:
        if self.group not in member_of:
            return column
        return F.when(column.like(self.pattern), column).otherwise(F.lit(self.mask))


# The policies of the consumption fact.
REGIONAL_FILTER = RowPolicy(frozenset({"Poland", "admins"}), "PL")
SITE_ID_MASK = MaskPolicy("Poland", "DC-PL-%", "**-**-**")


def row_filter(df: DataFrame, column: str, policies: Sequence[RowPolicy], member_of: Collection[str]) -> DataFrame:
    """Rows that some policy shows to the caller; a NULL value is never shown."""
    visible = F.lit(False)
    for policy in policies:
        visible = visible | F.coalesce(policy.visible(F.col(column), member_of), F.lit(False))
    return df.filter(visible)


def column_mask(df: DataFrame, column: str, policy: MaskPolicy, member_of: Collection[str]) -> DataFrame:
    """The column as the caller may see it. Group after masking: masked values become one group."""
    return df.withColumn(column, policy.masked(F.col(column), member_of))


def drop_personal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove personal columns; names that are not there are ignored."""
    return df.drop(*columns)


def create_sql_function(spark: SparkSession, name: str, argument: str, returns: str, body: str) -> None:
    """A temporary SQL scalar function of one string argument, inlined by the optimizer."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument} STRING) RETURNS {returns} RETURN {body}")
