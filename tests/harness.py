"""Run a registered Spark query and its DuckDB oracle on the same tables and compare.

Comparison: column names (sorted), row count, and the order-insensitive multiset of rows
(floats rounded to 9 significant digits, dates/timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, show: int = 5) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    if not out["cols_match"]:
        out["spark_only"] = sorted(set(scols) - set(dcols))
        out["oracle_only"] = sorted(set(dcols) - set(scols))
        out["match"] = False
        return out
    a, b = rows_key(srows, scols), rows_key(drows, dcols)
    out["match"] = a == b
    if not out["match"]:
        only_s = list((a - b).elements())[:show]
        only_d = list((b - a).elements())[:show]
        out["cols"] = sorted(scols)
        out["spark_only_rows"] = only_s
        out["oracle_only_rows"] = only_d
    return out
