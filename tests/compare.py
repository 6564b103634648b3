"""Run registered queries and their SQL side by side on one data folder."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, con, folder: str, build, sql: str) -> str | None:
    """None when columns, rows and values agree, otherwise what differs."""
    ours = build(spark, folder)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(ours.columns):
        return f"columns differ: {sorted(set(names) ^ set(ours.columns))}"
    left = canonical(ours.columns, [tuple(r) for r in ours.collect()])
    plan = ours._jdf.queryExecution().executedPlan().toString()
    pairwise = [node for node in ("CartesianProduct", "BroadcastNestedLoopJoin") if node in plan]
    if pairwise:
        return f"compares all pairs of rows: {pairwise}"
    right = canonical(names, theirs)
    if len(left) != len(right):
        return f"{len(left)} rows, SQL has {len(right)}"
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        first = [(n, a, b) for n, a, b in zip(sorted(names), *unequal[0]) if a != b]
        return f"{len(unequal)} rows differ, first: {first}"
    return None
