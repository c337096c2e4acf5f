"""Profiles that follow a table: one state per slice, stored, merged on demand.

A state holds what can be put together again: counts, least and greatest values, a HyperLogLog sketch
of the distinct values and, for numbers, a KLL sketch of their distribution. When slices of the table
change, only their states are made anew; a profile of the whole table reads states alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, NumericType, StructField, StructType

from millrace.session import materialise
from millrace.sources.slices import SliceTable

HLL_BITS = 12  # distinct counts with a standard error of 1.6 %
KLL_SIZE = 200  # ranks of quantiles within 1.7 %, at 99 % confidence


def _state_of(name: str, kind: StructField) -> Column:
    """The state of one column over some rows."""
    value = F.col(f"`{name}`")
    parts = [
        F.count_if(value.isNull()).alias("nulls"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
        F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias("distinct"),
    ]
    if isinstance(kind.dataType, NumericType):
        parts.append(F.kll_sketch_agg_double(value.cast("double"), KLL_SIZE).alias("spread"))
    return F.struct(*parts)


class ProfileStore:
    """States of the ``columns`` of a table whose slices are named by ``by`` (columns of the table)."""

    def __init__(self, spark: SparkSession, path: str, source: SliceTable, by: dict[str, str], columns: Sequence[str]):
        self.source, self.by, self.columns = source, by, list(columns)
        fields = [source.schema[c] for c in by.values()] + [StructField("n_rows", LongType())]
        for c in self.columns:
            kind = source.schema[c].dataType
            state = [("nulls", LongType()), ("least", kind), ("greatest", kind), ("distinct", BinaryType())]
            state += [("spread", BinaryType())] if isinstance(kind, NumericType) else []
            fields.append(StructField(f"of_{c}", StructType([StructField(n, t) for n, t in state])))
        self.states = SliceTable(spark, path, StructType(fields), {name: F.col(f"`{c}`") for name, c in by.items()})

    def _made(self, rows: DataFrame) -> DataFrame:
        states = [_state_of(c, self.source.schema[c]).alias(f"of_{c}") for c in self.columns]
        grouped = rows.groupBy(*[F.col(f"`{c}`") for c in self.by.values()])
        return materialise(grouped.agg(F.count(F.lit(1)).alias("n_rows"), *states), "profile-states")

    def rebuild(self) -> None:
        """The states of all slices, from one scan."""
        made = self._made(self.source.read())
        self.states.replace(made, self.states.counts(made))

    def refresh(self, changed: Iterable[Row]) -> None:
        """The states of these slices; no other slice is read, and those that are empty now lose theirs."""
        places = list(changed)
        made = self._made(self.source.read_slices(places))
        self.states.put(made, self.states.counts(made), places)

    def report(self, quantiles: Sequence[float] = (0.5,), by: Sequence[str] = ()) -> DataFrame:
        """One row per column (and value of ``by``): rows, nulls, least, greatest, distinct values, quantiles.

        The first four are exact. ``n_distinct`` comes from a sketch, ``quantiles`` too; they are NULL
        for columns that hold no number, and for a column without any value.
        """
        wide = []
        for c in self.columns:
            state = F.col(f"`of_{c}`")
            spread = F.lit(None).cast("array<double>")
            if isinstance(self.source.schema[c].dataType, NumericType):
                filled = F.when(state.least.isNotNull(), state.spread)
                merged = F.kll_merge_agg_double(filled, KLL_SIZE)
                spread = F.when(F.min(state.least).isNotNull(), F.kll_sketch_get_quantile_double(merged, F.array(*[F.lit(float(q)) for q in quantiles])))
            wide.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.sum("n_rows").alias("n_rows"),
                    F.sum(state.nulls).alias("nulls"),
                    F.min(state.least).cast("string").alias("least"),
                    F.max(state.greatest).cast("string").alias("greatest"),
                    F.hll_sketch_estimate(F.hll_union_agg(state.distinct)).alias("n_distinct"),
                    spread.alias("quantiles"),
                ).alias(f"p{len(wide)}")
            )
        merged = self.states.read().groupBy(*by).agg(*wide) if by else self.states.read().agg(*wide)
        return merged.select(*by, F.explode(F.array(*[f"p{k}" for k in range(len(wide))])).alias("p")).select(*by, "p.*")
