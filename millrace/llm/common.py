"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.ordering import sortable_columns

# A word, wherever an operator speaks of words: a run of anything but these six spaces.
# Fixed value, given by the contracts.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; ``bytes.split`` cuts at exactly the six spaces."""
    return text.encode("utf-8", "replace").split() if text else []


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def portions(lengths: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive items that add up to ``most`` at most; a longer item stands alone."""
    first = total = 0
    for i, n in enumerate(lengths):
        if i > first and total + n > most:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield slice(first, len(lengths))


def within(sizes: Sequence[int], most: int) -> list[bool]:
    """Which items are taken in turn, up to ``most`` together; one that no longer fits is passed over."""
    taken, total = [], 0
    for n in sizes:
        taken.append(total + n <= most)
        total += n * taken[-1]
    return taken


def row_key(*more: str) -> Column:
    """128 bits that stand for doc_id, text and ``more`` columns, never NULL; a null text counts as an empty one."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("null")) for c in ("doc_id", *more)]
    return F.md5(F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)], F.coalesce(F.col("text"), F.lit(""))))


def copy_number(docs: DataFrame, key: str) -> Column:
    """1, 2 ... for the rows of a key, in a fixed order of all their columns that can be hashed."""
    return F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*[col(c) for c in sortable_columns(docs)])))


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose ``row_key`` is among ``keys``, one row for each key, with all columns.

    The one shuffle of whole rows serves both the join and the choice among repeated rows.
    """
    key, n = unused(docs, "_key"), unused(docs, "_n")
    kept = docs.withColumn(key, row_key()).join(keys.select(F.col("row_key").alias(key)), key)
    return kept.withColumn(n, copy_number(docs, key)).filter(F.col(n) == 1).select(*[col(c) for c in docs.columns])
