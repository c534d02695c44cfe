"""Compare a registered plan with its SQL on the same files: names, row count and values, order-insensitive."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, root: str, fn, sql: str) -> str:
    """Empty text when both agree, else what differs."""
    df = fn(spark, root)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = [f"{n}:{t}" for n, t in df.dtypes if t.startswith(("decimal", "array", "map", "struct", "timestamp"))]
    if types:
        return f"unportable output types {types}"
    physical = df._jdf.queryExecution().executedPlan().toString()
    pairs = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in physical]
    if pairs:
        return f"plan compares all pairs: {pairs}"
    if not got:
        return "no rows"
    if got != want:
        a, b = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}; only spark {a}; only sql {b}"
    return ""
