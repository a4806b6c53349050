"""Runs a query and its SQL on the same tables and compares columns, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{Path(sf) / name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> str | None:
    """None if both agree, else what differs."""
    cursor = connection.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(sql_columns)}"
    got = [tuple(r) for r in spark_df.collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows / {len(expected)}"
    a, b = rows_of(spark_df.columns, got), rows_of(sql_columns, expected)
    for left, right in zip(a, b):
        if left != right:
            return f"{sorted(sql_columns)}: {left} / {right}"
    return None
