"""Compare a query's rows with its SQL on DuckDB, sorted by value."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=_key)


def differences(df, con, sql, tolerance=0.0):
    """Text of the first difference, or None."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            same = x == y
            if not same and isinstance(x, (int, float)) and isinstance(y, (int, float)):
                same = abs(x - y) <= tolerance
            if not same:
                return f"{dict(zip(got_cols, a))}\n != {dict(zip(got_cols, b))}"
    return None
