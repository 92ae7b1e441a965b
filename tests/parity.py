"""Run a query and its SQL twin side by side."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb

DATA = os.environ.get("PARITY_DATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, con, key: str, fn, twin: str | None, sf_dir: str) -> str | None:
    """None when both sides hold the same rows, else a short account of the difference."""
    df = fn(spark, sf_dir)
    rows = df.collect()
    if twin is None:
        return None if df.columns else "no columns"
    cursor = con.execute(twin)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = bag(df.columns, rows), bag(names, expected)
    if not rows:
        return "no rows: the comparison says nothing"
    if mine == theirs:
        return None
    extra, lacking = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
    return f"{len(rows)} rows against {len(expected)}; only here {extra}; only there {lacking}"
