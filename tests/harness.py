"""Compare a Spark query result with its DuckDB oracle SQL.

Columns are matched by name, rows are compared as multisets, floats are
rounded to 6 places, nested values are normalised to tuples.
"""

from __future__ import annotations

import datetime as dt
import math
import os

# QUARRY_EXACT_FLOATS=1 compares doubles bit for bit (no rounding).
EXACT = os.environ.get("QUARRY_EXACT_FLOATS") == "1"

import duckdb
from pyspark.sql import Row

from quarry.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, sort_lists=False):
    if isinstance(v, Row):
        return tuple(norm(x, sort_lists) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x, sort_lists) for x in v.values())
    if isinstance(v, list) and sort_lists:
        return tuple(sorted((norm(x, sort_lists) for x in v), key=repr))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, sort_lists) for x in v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = v if EXACT else round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def canon(cols, rows, sort_lists=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], sort_lists) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(df, con, sql: str, sort_lists: bool = False) -> tuple[bool, str]:
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count: spark={len(s_rows)} oracle={len(d_rows)}"
    a = canon(s_cols, s_rows, sort_lists)
    b = canon(d_cols, d_rows, sort_lists)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diff}"
    return True, f"{len(a)} rows"
