"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (int, float)):
        return float(value)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, folder, query, sql) -> str | None:
    """None when both give the same rows, else what differs."""
    table = query(spark, folder)
    found = table.collect()
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(table.columns):
        return f"columns {sorted(table.columns)} but {sorted(names)}"
    ours, theirs = bag(table.columns, found), bag(names, expected.fetchall())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows but {sum(theirs.values())}; "
        f"only ours {list((ours - theirs).items())[:3]}; only SQL {list((theirs - ours).items())[:3]}"
    )
