"""Compares a Spark result with a SQL result, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    names, rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    other_names, other = _rows([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(rows) != len(other):
        return f"{len(rows)} rows != {len(other)}"
    for a, b in zip(rows, other):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None
