"""Run a registered query and its SQL on the same files and compare every value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def compare(frame, con, sql: str) -> str | None:
    """None when equal, else the first difference in words."""
    got = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}"
    order = sorted(names)
    pick_g = [frame.columns.index(c) for c in order]
    pick_w = [names.index(c) for c in order]
    left = sorted((tuple(_plain(r[i]) for i in pick_g) for r in got), key=repr)
    right = sorted((tuple(_plain(r[i]) for i in pick_w) for r in want), key=repr)
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}: {left[:2]} vs {right[:2]}"
    for a, b in zip(left, right, strict=True):
        if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"{order}: {str(a)[:600]} vs {str(b)[:600]}"
    return None if left else "no rows on either side"
