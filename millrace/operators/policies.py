"""Row filters and column masks that are bound to a table: whoever reads it by name gets what they may see.

The policies are SQL functions over a value and the reader's groups; a view applies them. The groups of
a session are a variable of it, so one query gives each reader its own answer. A view that outlives the
session takes the groups of the current user from a table of memberships, as stored views cannot refer
to session variables.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType

from millrace.operators.security import MaskPolicy, RowPolicy

GROUPS = "member_of"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _array(values: Collection[str]) -> str:
    return f"cast(array({', '.join(_text(v) for v in sorted(values))}) as array<string>)"


def set_groups(spark: SparkSession, groups: Collection[str]) -> None:
    """The groups of whoever reads in this session from now on."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {GROUPS} ARRAY<STRING> DEFAULT {_array(groups)}")


def row_policy_sql(policies: Sequence[RowPolicy]) -> str:
    """Whether the groups ``g`` may see a row with the value ``v``; a NULL value is never shown."""
    shown = [f"(v = {_text(p.value)} AND size(array_except({_array(p.groups)}, g)) = 0)" for p in policies]
    return f"coalesce({' OR '.join(shown) or 'false'}, false)"


def mask_policy_sql(policy: MaskPolicy) -> str:
    """The value ``v`` as the groups ``g`` may see it."""
    return f"CASE WHEN NOT array_contains(g, {_text(policy.group)}) OR v LIKE {_text(policy.pattern)} THEN v ELSE {_text(policy.mask)} END"


def bind_policies(
    spark: SparkSession,
    view: str,
    table: str,
    *,
    rows: Mapping[str, Sequence[RowPolicy]],
    masks: Mapping[str, MaskPolicy],
    memberships: str | None = None,
) -> None:
    """A view of the table that shows the reader's rows and masks the reader's columns.

    Without ``memberships`` the view is one of the session, and ``set_groups`` says who reads. With the name of
    a stored table (user_name, group_name) view and functions are stored as well; who reads is ``current_user()``.

    Hidden values stay hidden from predicates with side effects too: every column is NULL on a row that the
    reader may not see, so whatever the optimizer does with the order of filters, a reader's own expression
    is never evaluated on a hidden value. Predicates on masked columns see the mask.
    """
    columns = spark.table(table).schema
    unknown = {*rows, *masks} - set(columns.names)
    if unknown:
        raise ValueError(f"{table} has no {sorted(unknown)}")
    for c in (*rows, *masks):
        if not isinstance(columns[c].dataType, StringType):
            raise TypeError(f"policies are for text, {c} is {columns[c].dataType.simpleString()}")
    kind = "" if memberships else "TEMPORARY "
    prefix = view.split(".")[-1]
    if memberships:
        groups = f"(SELECT coalesce(collect_set(group_name), {_array(())}) FROM {memberships} WHERE user_name = current_user())"
    else:
        groups = f"coalesce(session.{GROUPS}, {_array(())})"

    def function(column: str, role: str, returns: str, body: str) -> str:
        name = _name(f"{prefix}_{role}_{column}")
        name = name if not memberships or "." not in view else f"{view.rsplit('.', 1)[0]}.{name}"
        spark.sql(f"CREATE OR REPLACE {kind}FUNCTION {name}(v STRING, g ARRAY<STRING>) RETURNS {returns} RETURN {body}")
        return f"{name}({_name(column)}, {groups})"

    shown = [function(c, "shows", "BOOLEAN", row_policy_sql(p)) for c, p in rows.items()]
    masked = {c: function(c, "masks", "STRING", mask_policy_sql(p)) for c, p in masks.items()}
    visible = " AND ".join(shown) or "true"
    seen = [f"CASE WHEN {visible} THEN {masked.get(c, _name(c))} END AS {_name(c)}" for c in columns.names]
    spark.sql(f"CREATE OR REPLACE {kind}VIEW {view} AS SELECT {', '.join(seen)} FROM {table} WHERE {visible}")
