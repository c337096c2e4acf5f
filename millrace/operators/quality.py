"""Named data-quality rules: drop, fail, report, quarantine; gates and volume alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.calendar import date_spine
from millrace.operators.dedup import key_counts
from millrace.spec import Rule, TableSpec


class RuleViolation(ValueError):
    """Rows break a rule that must hold."""


def _all_hold(rules: Sequence[Rule]) -> Column:
    test = F.lit(True)
    for rule in rules:
        test = test & rule.holds()
    return test


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only rows for which every rule holds. Works on streams."""
    return df.filter(_all_hold(rules))


def expect_or_fail(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows, but reading one that breaks a rule fails the job.

    The check runs inside the scan of the rows, without a counting pass before, and
    works the same in a stream, where it fails the micro-batch.
    """
    test = F.lit(True)
    for rule in rules:
        message = F.lit(f"rule {rule.name} is violated: {rule.predicate}")
        test = test & F.when(rule.holds(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(test)


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with passed and failed rows, from a single pass. Passed and failed add up to all rows."""
    counts = [F.count_if(r.holds()).alias(f"p{i}") for i, r in enumerate(rules)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col(f"p{i}").alias("passed"),
            (F.col("n") - F.col(f"p{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*lines)))


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise if any row breaks a rule, naming all broken rules and their counts."""
    broken = [f"{r.rule}: {r.failed} rows" for r in rule_metrics(df, rules).collect() if r.failed]
    if broken:
        raise RuleViolation("; ".join(broken))


def check_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A batch in the table's types, refused as a whole if a declared rule is broken."""
    conformed = spec.conform(df)
    if spec.rules():
        check_rules(conformed, spec.rules())
    return conformed


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break rules, each with the names of those rules."""
    broken = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))
    return df.withColumn("violated_rules", broken).filter(F.size("violated_rules") > 0)


def gate_report(df: DataFrame, *, keys: Sequence[str], not_null: Sequence[str], ranges: Sequence[Rule]) -> DataFrame:
    """Non-empty, no NULL in key columns, unique keys and value ranges: one row per check.

    All checks come from one aggregation by key, which is combined before the shuffle,
    so a repeated key costs no more than a single one. Keys compare NULL as a value.
    """
    tests = {"null_keys": F.lit(False), **{r.name: ~r.holds() for r in ranges}}
    for c in not_null:
        tests["null_keys"] = tests["null_keys"] | F.col(c).isNull()
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(t).alias(n) for n, t in tests.items()]
    )
    total = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("_rows"),
        F.count(F.lit(1)).alias("_keys"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in tests],
    )
    bad = {
        "non_empty": F.when(F.col("_rows") == 0, 1).otherwise(0).cast("bigint"),
        "unique_keys": F.col("_rows") - F.col("_keys"),
        **{n: F.col(n) for n in tests},
    }
    lines = [
        F.struct(
            F.lit(n).alias("check_name"),
            c.alias("bad_rows"),
            F.when(c > 0, "FAIL").otherwise("PASS").alias("status"),
        )
        for n, c in bad.items()
    ]
    return total.select(F.inline(F.array(*lines)))


def require_gate(report: DataFrame) -> None:
    """Raise if a check of the report failed."""
    failed = [f"{r.check_name}: {r.bad_rows}" for r in report.filter("status = 'FAIL'").collect()]
    if failed:
        raise RuleViolation("; ".join(failed))


def _status(rows: Column, threshold: int) -> Column:
    return F.when(rows < threshold, "TRIGGERED").otherwise("OK")


def volume_alert(df: DataFrame, day_column: str, day: dt.date | Column | None, threshold: int) -> DataFrame:
    """Rows of one day (today by default) and whether they stay below the threshold."""
    wanted = F.current_date() if day is None else day if isinstance(day, Column) else F.lit(day)
    return (
        df.filter(F.col(day_column) == wanted)
        .agg(F.count(F.lit(1)).alias("rows_today"))
        .withColumn("status", _status(F.col("rows_today"), threshold))
    )


def volume_by_day(df: DataFrame, day_column: str, threshold: int) -> DataFrame:
    """The alert for every day of the covered period; a day without rows counts as 0."""
    counts = key_counts(df.select(day_column), [day_column])
    return (
        date_spine(counts, day_column)
        .join(counts, day_column, "left")
        .select(day_column, F.coalesce("n_rows", F.lit(0)).alias("rows_today"))
        .withColumn("status", _status(F.col("rows_today"), threshold))
    )


def table_audit(df: DataFrame, name: str, keys: Sequence[str], measure: str) -> DataFrame:
    """One summary row of a table: rows, complete distinct keys, NULLs of a measure."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(measure).isNull()).alias("nulls")
    )
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count_if(complete).alias("unique_keys"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("bigint").alias("null_values"),
    )
