"""Compare the registered queries with their DuckDB statements on one folder of tables."""

from __future__ import annotations

import glob
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered  # noqa: E402
from oracle_queries import ORACLE, ORDERED  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, name: str, folder: str) -> str | None:
    """None when both engines give the same columns and rows, in the same order where one is stated."""
    frame = registered.queries()[name](spark, folder)
    cursor = con.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected, actual = cursor.fetchall(), [tuple(r) for r in frame.collect()]
    if name in ORDERED:
        if columns != frame.columns:
            return f"columns {frame.columns} != {columns}"
    else:
        if sorted(columns) != sorted(frame.columns):
            return f"columns {sorted(frame.columns)} != {sorted(columns)}"
        expected, actual = rows_of(columns, expected), rows_of(frame.columns, actual)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None
