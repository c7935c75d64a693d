"""Runs a registered query and its check SQL and compares all rows."""

from __future__ import annotations

import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, sql, sf_dir) -> str | None:
    """None if both give the same rows, types aside; else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{got.total()} rows instead of {want.total()}; {extra.total()} extra, e.g. "
            f"{list(extra)[:2]}; {lacking.total()} missing, e.g. {list(lacking)[:2]}"
        )
    return None
