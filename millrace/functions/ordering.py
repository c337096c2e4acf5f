"""Cuts in the real order of a column, slots between them, and curves through the slots of several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def sortable(data_type: DataType) -> bool:
    """Whether Spark can order values of the type: no map or variant at any depth."""
    if isinstance(data_type, StructType):
        return all(sortable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, ArrayType):
        return sortable(data_type.elementType)
    return not isinstance(data_type, (MapType, VariantType))


def sortable_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if sortable(f.dataType)]


def cuts(df: DataFrame, key: str, slots: int) -> list:
    """Ascending values that cut the key's own order into up to ``slots`` stretches of about as many rows.

    The key alone is range-partitioned and the least value of each partition comes back, so
    every type that sorts will do: long common prefixes, NaN and infinities included. A
    value that fills several stretches is one cut.
    """
    keys = df.select(F.col(f"`{key}`").alias("k")).filter(F.col("k").isNotNull())
    placed = keys.repartitionByRange(slots, "k").select("k", F.spark_partition_id().alias("p"))
    firsts = placed.groupBy("p").agg(F.min("k").alias("first")).orderBy("first").collect()  # one row per slot
    return [r.first for r in firsts][1:] if firsts else []


def slot_of(key: str, data_type: DataType, cut_values: Sequence) -> Column:
    """How many cuts are at or below the value, found by halving; 0 for NULL."""
    n = len(cut_values)
    if not n:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cut_values]).cast(ArrayType(data_type))
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    value = F.col(f"`{key}`")

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= value), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def interleave(slots: Sequence[Column], bits: int) -> Column:
    """Bits of several small integers taken in turn, the highest bits first."""
    if len(slots) * bits > 62:
        raise ValueError("more than 62 bits do not fit one bigint")
    value = F.lit(0).cast("bigint")
    for bit in range(bits):
        for position, slot in enumerate(slots):
            one = F.shiftright(slot.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            shift = bit * len(slots) + (len(slots) - 1 - position)
            value = value.bitwiseOR(F.shiftleft(one, shift))
    return value


def with_hilbert_value(df: DataFrame, name: str, slots: Sequence[Column], bits: int) -> DataFrame:
    """Add the place of the slots, ``2**bits`` for each of one to four columns, on the Hilbert curve.

    Neighbours on the curve are neighbours in space, which the Z curve, with its jumps, does not keep. The
    axes are turned bit by bit from the highest (Skilling's transpose form): a step exchanges or inverts
    the low bits of the first axis and one other. Every step is a projection of plain integer
    operations, so the whole chain is compiled code.
    """
    if len(slots) * bits > 62:
        raise ValueError("more than 62 bits do not fit one bigint")
    axes = []
    for i in range(len(slots)):
        axis = f"_axis{i}"
        while axis.lower() in {c.lower() for c in df.columns}:
            axis = f"_{axis}"
        axes.append(axis)
    df = df.withColumns({axis: slot.cast("bigint") for axis, slot in zip(axes, slots)})
    first = F.col(axes[0])
    for bit in range(bits - 1, 0, -1):
        high, low = F.lit(1 << bit).cast("bigint"), F.lit((1 << bit) - 1).cast("bigint")
        for axis in axes:
            this = F.col(axis)
            inverted = this.bitwiseAND(high) != 0
            exchanged = first.bitwiseXOR(this).bitwiseAND(low)
            turned = {axes[0]: first.bitwiseXOR(F.when(inverted, low).otherwise(exchanged))}
            if axis != axes[0]:
                turned[axis] = F.when(inverted, this).otherwise(this.bitwiseXOR(exchanged))
            df = df.withColumns(turned)
    for before, axis in zip(axes, axes[1:]):  # Gray code along the axes
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    last = F.col(axes[-1])
    turn = F.lit(0).cast("bigint")
    for bit in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)).cast("bigint"))
    df = df.withColumns({axis: F.col(axis).bitwiseXOR(turn) for axis in axes})
    return df.withColumn(name, interleave([F.col(axis) for axis in axes], bits)).drop(*axes)
