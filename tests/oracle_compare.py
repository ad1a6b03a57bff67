"""Run a registered Spark query and its DuckDB oracle on the same parquet files and compare.

Row count, column names and an order-insensitive hash of the values
(floats rounded to 6 places, -0.0 as 0.0).
"""

from __future__ import annotations

import hashlib
import math
import os

# LEDGERLINE_EXACT=1 compares floats bit for bit (no rounding)
EXACT = os.environ.get("LEDGERLINE_EXACT") == "1"

import duckdb

from ledgerline.plans.inputs import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        r = v if EXACT else round(v, 6)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def table_hash(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    out["hash_match"] = out["cols_match"] and table_hash(s_cols, s_rows) == table_hash(d_cols, d_rows)
    out["status"] = "ok" if (out["hash_match"] and len(s_rows) == len(d_rows)) else "MISMATCH"
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
    return out


def first_difference(spark, fn, sql, sf_dir, limit=5):
    """Rows only on one side, for debugging a mismatch."""
    df = fn(spark, sf_dir)
    cols = df.columns
    s = {"|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect()}
    con = duck(sf_dir)
    res = con.execute(sql)
    dc = [c[0] for c in res.description]
    idx = sorted(range(len(dc)), key=lambda i: dc[i])
    d = {"|".join(_norm(r[i]) for i in idx) for r in res.fetchall()}
    return sorted(s - d)[:limit], sorted(d - s)[:limit]
