"""Schema enforcement and evolution for tables without a transactional format."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructType


class SchemaMismatch(ValueError):
    """A batch does not fit the stored schema."""


def check_same_columns(stored: StructType, incoming: StructType) -> None:
    """Refuse new columns and changed types; a missing column is allowed and reads as NULL."""
    widen(stored, incoming, allow_new=False)


def widen(stored: StructType, incoming: StructType, *, allow_new: bool) -> StructType:
    """The stored schema plus the new columns of a batch."""
    known = {f.name: f for f in stored.fields}
    extra = [f for f in incoming.fields if f.name not in known]
    if extra and not allow_new:
        raise SchemaMismatch(f"new columns {[f.name for f in extra]} are not in the table")
    for f in incoming.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise SchemaMismatch(
                f"column {f.name} is {known[f.name].dataType.simpleString()}, "
                f"the batch has {f.dataType.simpleString()}"
            )
    return StructType(stored.fields + extra)


def merge_append(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Both row sets under the wider schema; absent columns are NULL."""
    widen(table.schema, batch.schema, allow_new=True)
    return table.unionByName(batch, allowMissingColumns=True)


def add_column(df: DataFrame, name: str, data_type: DataType | str) -> DataFrame:
    """Add an all-NULL column; nothing happens if it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    if old not in df.columns:
        raise SchemaMismatch(f"no column {old}")
    if new in df.columns:
        raise SchemaMismatch(f"column {new} exists already")
    return df.withColumnRenamed(old, new)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise SchemaMismatch(f"no column {name}")
    return df.drop(name)
