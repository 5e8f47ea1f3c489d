"""Test helper: compare a Spark result with a DuckDB oracle result
(order-insensitive).

Used by the tests; mirrors an external gate that checks row count,
column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLE_NAMES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits is None else round(v, digits)
    if isinstance(v, decimal.Decimal):
        return float(v) if digits is None else round(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def normalized(columns, rows, digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return [columns[i] for i in order], out


def compare(spark_df, con, sql: str, digits=None):
    """Return (ok, message); values must be equal exactly unless ``digits``."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(d_rows)}"
    _, a = normalized(s_cols, s_rows, digits)
    _, b = normalized(d_cols, d_rows, digits)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(s_rows)} rows match"
