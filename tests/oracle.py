"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names (sorted) and an order-insensitive multiset of rows.

Test helper only: results here are small marts, so collecting them is fine.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

from hirelake.sources.tables import DRIVER_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return cols, sorted(out, key=_key)


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(df, con, sql):
    """Return (ok, message)."""
    s_cols, s_rows = canonical(*spark_rows(df))
    d_cols, d_rows = canonical(*duck_rows(con, sql))
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    if s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ ({len(s_rows)} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows equal"
