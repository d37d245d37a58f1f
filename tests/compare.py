"""Spark result against the SQL twin, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str, limit: int = 5) -> list[str]:
    """Empty when both results hold the same rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(expected) != len(actual):
        return [f"{len(actual)} rows, expected {len(expected)}"]
    out = [
        f"{a} != {e}"
        for a, e in zip(actual, expected)
        if repr(a) != repr(e)
    ]
    return out[:limit]
