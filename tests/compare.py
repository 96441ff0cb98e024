"""Compare a Spark DataFrame with DuckDB's answer: schema names, row count, values."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def kind(v) -> str:
    return type(v).__name__


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(value(r[i]) for i in order) for r in rows), sorted(cols)


def mismatch(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    a, cols = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    b, other = rows_of([d[0] for d in res.description], res.fetchall())
    if cols != other:
        return f"columns differ: {sorted(set(cols) ^ set(other))}"
    if a == b:
        return None
    left, right = list((a - b).elements()), list((b - a).elements())
    hint = ""
    if left and right:
        x = left[0]
        y = min(right, key=lambda r: sum(p != q for p, q in zip(x, r)))
        hint = str([(c, p, q) for c, p, q in zip(cols, x, y) if p != q][:5])
    return (
        f"{sum(a.values())} vs {sum(b.values())} rows, {len(left)} only in Spark, "
        f"{len(right)} only in the oracle {hint}"
    )
