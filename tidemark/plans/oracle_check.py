"""Compare a Spark result with a DuckDB oracle result: row count, sorted
column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

from tidemark.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, tol=False):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return float(f"{v:.6g}") if tol else repr(v)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, tol)) for k, x in v.items()))
    return str(v)


def digest(rows, tol=False):
    hs = sorted(hashlib.md5(repr(tuple(norm(x, tol) for x in r)).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


def by_name(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), [tuple(r[i] for i in idx) for r in rows]


def compare(spark_cols, spark_rows, oracle_cols, oracle_rows):
    """Return (status, detail); status is OK, OK~TOL or MISMATCH."""
    sc, sr = by_name(spark_cols, spark_rows)
    oc, orr = by_name(oracle_cols, oracle_rows)
    if sc != oc:
        return "MISMATCH", f"columns {sc} vs {oc}"
    if len(sr) != len(orr):
        return "MISMATCH", f"rows {len(sr)} vs {len(orr)}"
    if digest(sr) == digest(orr):
        return "OK", ""
    if digest(sr, True) == digest(orr, True):
        return "OK~TOL", "float noise only"
    a = {tuple(norm(x, True) for x in r) for r in sr}
    b = {tuple(norm(x, True) for x in r) for r in orr}
    return "MISMATCH", f"spark-only {list(a - b)[:3]} oracle-only {list(b - a)[:3]}"
