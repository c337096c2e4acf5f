"""Type-2 dimension history: seed, apply changes, read back, look up as of a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType

from millrace.operators.numbering import number_rows
from millrace.operators.upsert import require_unique
from millrace.session import materialise

VALIDITY = ("valid_from", "valid_to", "is_current")


def _stamp(spark: SparkSession, effective: dt.datetime | Column | None, like: str) -> Column:
    """The effective time as a constant: without one the clock is read here, once, so that the
    end of one version and the start of the next are the same however often they are computed."""
    if effective is None:
        now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
        return F.timestamp_micros(F.lit(now)).cast(like)
    return (effective if isinstance(effective, Column) else F.lit(effective)).cast(like)


def open_rows(df: DataFrame, effective: dt.datetime | Column | None = None, like: str = "timestamp") -> DataFrame:
    """Distinct rows as current, open-ended versions."""
    return df.distinct().withColumns(
        {
            "valid_from": _stamp(df.sparkSession, effective, like),
            "valid_to": F.lit(None).cast(like),
            "is_current": F.lit(True),
        }
    )


def seed_history(
    df: DataFrame,
    *,
    surrogate: str,
    order: str,
    effective: dt.datetime | Column | None = None,
    like: str = "timestamp",
) -> DataFrame:
    """First load of a dimension: every distinct row is current and gets a surrogate key."""
    numbered = number_rows(open_rows(df, effective, like), order, surrogate)
    return numbered.select(surrogate, *df.columns, *VALIDITY)


def apply_changes(
    dim: DataFrame,
    updates: DataFrame,
    *,
    keys: Sequence[str],
    tracked: Sequence[str],
    surrogate: str,
    order: str,
    effective: dt.datetime | Column | None = None,
    null_safe: bool = False,
    check: bool = True,
) -> DataFrame:
    """Close current rows whose tracked columns changed, open their new version, add unseen keys.

    Rows that did not change, and history, pass through; so the same batch applied
    again changes nothing. With ``null_safe`` a change from or to NULL counts too;
    by default ``<>`` decides and NULL never counts as changed. A change that is older than
    the version it would close is refused: ``changelog.apply_late_changes`` takes those.
    """
    if check:
        require_unique(updates, keys)
    like = dim.schema["valid_from"].dataType.simpleString()
    now = _stamp(dim.sparkSession, effective, like)
    attributes = [c for c in updates.columns if c in dim.columns]

    changed = F.lit(False)
    for c in tracked:
        differs = ~F.col(f"d.{c}").eqNullSafe(F.col(f"u.{c}")) if null_safe else F.col(f"d.{c}") != F.col(f"u.{c}")
        changed = changed | F.coalesce(differs, F.lit(False))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & (F.col(f"d.{k}") == F.col(f"u.{k}"))

    current = dim.filter("is_current").alias("d")
    u = updates.alias("u")
    late = F.raise_error(F.concat(F.lit("late change: the version it would close starts at "), F.col("d.valid_from").cast("string")))
    changed = F.when(changed & (now < F.col("d.valid_from")), late.cast("boolean")).otherwise(changed)

    # One row per update that meets a current row; from here on only the batch is joined.
    matched = u.join(current, same_key).select(*[F.col(f"u.{c}").alias(c) for c in updates.columns], changed.alias("_changed"))
    matched = materialise(matched, "matched")
    closing = matched.filter("_changed").select(*keys, F.lit(True).alias("_closing"))
    unseen = updates.join(matched.select(*keys), list(keys), "left_anti")

    opened = matched.filter("_changed").select(*attributes).unionByName(unseen.select(*attributes))
    opened = opened.withColumns(
        {"valid_from": now, "valid_to": F.lit(None).cast(like), "is_current": F.lit(True)}
    )
    opened = materialise(opened, "opened")
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)) + 1).scalar()
    opened = number_rows(opened, order, surrogate, start=highest)

    # `_closing` is NULL for history and for current rows without a change.
    marked = dim.join(closing.withColumn("is_current", F.lit(True)), [*keys, "is_current"], "left")
    rest = marked.select(
        *[F.col(c) for c in dim.columns if c not in ("valid_to", "is_current")],
        F.when(F.col("_closing"), now).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & F.col("_closing").isNull()).alias("is_current"),
    ).select(*dim.columns)
    return rest.unionByName(opened, allowMissingColumns=True)


def versions_of(dim: DataFrame, key: str, value: object) -> DataFrame:
    """All versions of one business key, oldest first."""
    return dim.filter(F.col(key) == F.lit(value)).orderBy("valid_from")


def current_rows(dim: DataFrame) -> DataFrame:
    """One row per business key: safe to join a fact to."""
    return dim.filter("is_current")


def _wider(a: DataType, b: DataType) -> str:
    """A type in which dates and times of both kinds can be compared without loss."""
    kinds = {a.simpleString(), b.simpleString()}
    if len(kinds) == 1:
        return kinds.pop()
    return "timestamp" if "timestamp" in kinds else "timestamp_ntz"


def as_of_lookup(facts: DataFrame, dim: DataFrame, *, key: str, at: str, columns: Sequence[str]) -> DataFrame:
    """Attach the version that was valid at ``at``: ``valid_from <= at < valid_to``; NULL if none.

    Versions and facts are put into one order of key and time, and a fact takes the last
    version before it. The order is cut into tasks by range, so a key that holds most
    facts or versions is many tasks, and no fact meets more than one version. What a task
    inherits for its first key comes from one row per key and task. Facts without key or
    time have no version and stay out of the sort. The versions of a key must not overlap.
    """
    kind = _wider(facts.schema[at].dataType, dim.schema["valid_from"].dataType)
    version = F.struct(*[F.col(f"`{c}`") for c in columns], F.col("valid_to").cast(kind).alias("_until"))
    v = dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").cast(kind).alias("_at"), F.lit(0).alias("_kind"),
        F.col("valid_to").cast(kind).alias("_until"), version.alias("_version"),
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    has_both = F.col(f"`{key}`").isNotNull() & F.col(f"`{at}`").isNotNull()
    f = facts.filter(has_both).select(
        F.col(key).alias("_key"), F.col(at).cast(kind).alias("_at"), F.lit(1).alias("_kind"), whole.alias("_fact")
    )
    both = f.unionByName(v, allowMissingColumns=True).withColumn("_place", F.monotonically_increasing_id())
    order = [F.col("_key"), F.col("_at"), F.col("_kind"), F.col("_until").asc_nulls_last(), F.col("_place")]
    placed = materialise(both.repartitionByRange(*order).withColumn("_task", F.spark_partition_id()), "timeline")

    newest = F.max_by("_version", F.struct("_at", F.col("_until").isNull(), "_until"))
    per_task = placed.filter("_kind = 0").groupBy("_key", "_task").agg(newest.alias("_last"))
    tasks = placed.select("_key", "_task").distinct().join(per_task, ["_key", "_task"], "left")
    earlier = Window.partitionBy("_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    inherited = tasks.select("_key", "_task", F.last("_last", ignorenulls=True).over(earlier).alias("_inherited"))

    until_here = Window.partitionBy("_key", "_task").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    found = placed.withColumn("_found", F.last("_version", ignorenulls=True).over(until_here)).filter("_kind = 1")
    last = found.join(inherited, ["_key", "_task"], "left").select("_fact", "_at", F.coalesce("_found", "_inherited").alias("_v"))
    valid = F.col("_v._until").isNull() | (F.col("_at") < F.col("_v._until"))
    attached = last.select("_fact.*", *[F.when(valid, F.col("_v")[c]).alias(c) for c in columns])
    return attached.unionByName(facts.filter(~has_both), allowMissingColumns=True)
