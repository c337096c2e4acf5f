"""Type-2 history from a log of changes that may come late and in any order.

A dimension alone cannot take a late change: a value that was seen again leaves no trace in it,
so what holds after the late change is lost. The log keeps every observation, and the versions of a
key follow from it by one sort, whatever the order in which the log was filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.dedup import keep_latest
from millrace.operators.history import VALIDITY
from millrace.operators.numbering import number_rows
from millrace.operators.quality import expect_or_fail
from millrace.session import materialise
from millrace.spec import Rule


def _across(rows: DataFrame, keys: Sequence[str], value: Column, name: str, *, later: bool) -> DataFrame:
    """keys, _task, ``name``: what the neighbouring task that holds rows of the key has at its near end.

    Only keys whose rows lie in several tasks have a row here, one at most for each task.
    """
    near = F.min_by(value, "_at") if later else F.max_by(value, "_at")
    ends = rows.groupBy(*keys, "_task").agg(near.alias("_end"))
    tasks = Window.partitionBy(*keys).orderBy("_task")
    beside = F.lead("_end").over(tasks) if later else F.lag("_end").over(tasks)
    found = ends.withColumn(name, beside).filter(F.col(name).isNotNull()).select(*keys, "_task", name)
    return materialise(found, "task-ends", few_files=True)  # its size tells that it may be broadcast


def build_history(
    log: DataFrame, *, keys: Sequence[str], tracked: Sequence[str], at: str, sequence: Sequence[str] = (), deleted: str | None = None
) -> DataFrame:
    """keys, tracked, valid_from, valid_to, is_current: the versions that the log adds up to.

    Every entry says which values a key has from ``at`` on; entries that repeat the values before
    them open no version, NULL being a value like any other. Of several entries of one moment the
    highest ``sequence`` counts, then the other columns. Where ``deleted`` is true the key ends; a
    later entry opens it again. An entry without key or time stops the job that reads the result.

    The log is put into one order of key and time and cut into tasks by range, so a key with very
    many entries is many tasks; a task takes over what its neighbours hold of its first and last key.
    """
    gone = F.coalesce(F.col(f"`{deleted}`"), F.lit(False)) if deleted else F.lit(False)
    named = expect_or_fail(log, [Rule(f"{c}_present", f"`{c}` IS NOT NULL") for c in (*keys, at)])
    entries = named.select(*keys, *tracked, F.col(f"`{at}`").alias("_at"), gone.alias("_gone"), *[F.col(f"`{c}`").alias(f"_s{i}") for i, c in enumerate(sequence)])
    entries = keep_latest(entries, [*keys, "_at"], [f"_s{i}" for i in range(len(sequence))])
    # of a deleted key the values do not matter
    state = F.struct(F.col("_gone"), *[F.when(~F.col("_gone"), F.col(f"`{c}`")).alias(f"_v{i}") for i, c in enumerate(tracked)])
    entries = entries.select(*keys, "_at", "_gone", *tracked, state.alias("_state"))
    order = [F.col(f"`{k}`") for k in keys] + [F.col("_at")]
    placed = materialise(entries.repartitionByRange(*order).withColumn("_task", F.spark_partition_id()), "change-log")

    inside = Window.partitionBy(*keys, "_task").orderBy("_at")
    before = _across(placed, keys, F.col("_state"), "_inherited", later=False)
    seen = placed.withColumn("_before", F.lag("_state").over(inside)).join(before, [*keys, "_task"], "left")
    # of the rows of a task only the first has nothing before it
    seen = seen.withColumn("_before", F.coalesce("_before", "_inherited"))
    opens = F.when(F.col("_before").isNull(), ~F.col("_gone")).otherwise(~F.col("_state").eqNullSafe(F.col("_before")))
    runs = materialise(seen.filter(opens).select(*keys, *tracked, "_at", "_gone", "_task"), "runs")

    after = _across(runs, keys, F.col("_at"), "_follows", later=True)
    ended = runs.withColumn("_next", F.lead("_at").over(inside)).join(after, [*keys, "_task"], "left")
    ended = ended.withColumn("valid_to", F.coalesce("_next", "_follows")).filter(~F.col("_gone"))
    return ended.select(*keys, *tracked, F.col("_at").alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def apply_late_changes(
    dim: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    surrogate: str,
    sequence: Sequence[str] = (),
    deleted: str | None = None,
) -> DataFrame:
    """The dimension after a batch of changes of any age: versions are closed, split, opened and merged.

    ``log`` holds all changes that were applied before. The keys of the batch are rebuilt from log
    and batch, the versions of all others pass through. A version that stays, by key and start,
    keeps its surrogate key; new ones are numbered on, in the order of their start. A batch that is
    applied again changes nothing.
    """
    touched = materialise(batch.select(*keys).distinct(), "touched-keys")
    entries = log.join(touched, list(keys), "left_semi").unionByName(batch, allowMissingColumns=True)
    built = build_history(entries, keys=keys, tracked=tracked, at=at, sequence=sequence, deleted=deleted)
    known = dim.join(touched, list(keys), "left_semi").select(*keys, "valid_from", surrogate)
    built = materialise(built.join(known, [*keys, "valid_from"], "left"), "rebuilt")
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)) + 1).scalar()
    new = built.filter(F.col(surrogate).isNull()).drop(surrogate)
    numbered = number_rows(new, "valid_from", surrogate, start=highest)
    columns = [surrogate, *keys, *tracked, *VALIDITY]
    rest = dim.join(touched, list(keys), "left_anti").select(*columns)
    return rest.unionByName(built.filter(F.col(surrogate).isNotNull()).select(*columns)).unionByName(numbered.select(*columns))


def overlapping(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that end before they begin or reach into the next one of their key: none in a sound history."""
    following = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from", F.asc_nulls_last("valid_to")))
    wrong = (F.col("valid_to") <= F.col("valid_from")) | (F.col("_next") < F.coalesce("valid_to", F.col("_next") + F.expr("interval 1 day")))
    return dim.withColumn("_next", following).filter(wrong).drop("_next")

