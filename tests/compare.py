"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# no pairs of all rows, no Python in the plan
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")
FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
}


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, case, sf: str) -> list[str]:
    """Differences in words; none if the results are the same."""
    df = case.run(spark, sf)
    got = _rows(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = [w for w in UNWANTED if w in plan]
    if unwanted:
        return [f"plan has {unwanted}"]
    if case.sql is None:
        return [] if got else ["no rows"]
    cursor = con.execute(case.sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).upper() for d in cursor.description}
    want = _rows(names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but SQL {sorted(names)}"]
    for name, kind in df.dtypes:
        if FAMILIES.get(kind, kind) != types[name]:
            problems.append(f"{name}: {kind} but SQL {types[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows but SQL {len(want)}")
    if got != want:
        extra = sorted(set(got) - set(want))[:2]
        missing = sorted(set(want) - set(got))[:2]
        problems.append(f"values differ, only Spark {extra}, only SQL {missing}")
    return problems
