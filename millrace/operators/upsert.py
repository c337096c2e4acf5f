"""Keyed upserts.

The plain form reads the target once and meets it with the keys of the batch; no hint is
given: a small batch is broadcast by its measured size and the target is then not shuffled
at all, a large batch becomes a sort-merge join that AQE can split. The sequenced form is
one choice of the newest row per key over both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.dedup import duplicate_groups, keep_latest
from millrace.session import materialise


class AmbiguousSource(ValueError):
    """Two source rows match the same target row."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a complete key occurs twice."""
    found = duplicate_groups(df.select(*keys).dropna(how="any"), keys).limit(1).collect()
    if found:
        raise AmbiguousSource(f"more than one source row for key {found[0].asDict()}")


class MissingKey(ValueError):
    """A source row without a complete key: it would be inserted again by every repeat."""


def require_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a row lacks a part of its key."""
    if df.select(*keys).filter(_incomplete(keys)).limit(1).collect():
        raise MissingKey(f"a source row without {list(keys)}")


def _incomplete(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], *, check: bool = True) -> DataFrame:
    """Replace target rows whose key is in ``updates``, keep the others, insert the rest.

    The batch is computed once, and refused if a key occurs twice or is NULL. Target rows
    without a key are kept. Columns that only one side has come out as NULL for rows of the other.
    """
    if check:
        updates = materialise(updates, "batch")
        require_unique(updates, keys)
        require_keys(updates, keys)
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates, allowMissingColumns=True)


def upsert_sequenced(target: DataFrame, updates: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Upsert in which the higher ``sequence`` wins and the target wins ties.

    Both sides are read once, and of every key the newest row stays, so applying a batch
    twice or late changes nothing. A NULL sequence is older than any other. An update
    without a key stops the job that reads the result; target rows without a key are kept.
    """
    named = F.when(
        _incomplete(keys), F.raise_error(F.lit(f"a source row without {list(keys)}")).cast("boolean")
    ).otherwise(F.lit(False))
    alone = F.when(_incomplete(keys), F.monotonically_increasing_id())
    both = target.withColumns({"_held": F.lit(True), "_alone": alone}).unionByName(
        updates.withColumns({"_held": named, "_alone": F.lit(None).cast("long")}), allowMissingColumns=True
    )
    return keep_latest(both, [*keys, "_alone"], [sequence, "_held"]).drop("_held", "_alone")
