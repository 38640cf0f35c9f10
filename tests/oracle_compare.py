"""Run a Spark DataFrame and a DuckDB query side by side and compare them.

Order-insensitive: both results are normalised (nulls, float rounding,
timestamps to ISO text), columns sorted by name, rows sorted, then compared
row for row. Used by the tests and by ``tests/run_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0)
                 for v in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            diff = {c: (x, y) for c, x, y in zip(sc, a, b) if x != y}
            return False, f"first differing row: {diff}"
    return True, f"{len(sr)} rows equal"
