"""Compare a Spark result with the checking SQL, values and types."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from catalog.bindings import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return v


def kind(v) -> str:
    return {bool: "bool", int: "int", float: "float", str: "text"}.get(type(v), type(v).__name__)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(r) for r in df.select(*cols).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(r[i] for i in order) for r in cur.fetchall()]


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else a short description."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns differ: {sorted(set(sc) ^ set(dc))}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}"
    for i, c in enumerate(sc):
        a = {kind(plain(r[i])) for r in sr} - {"NoneType"}
        b = {kind(plain(r[i])) for r in dr} - {"NoneType"}
        if a != b:
            return f"column {c}: types {a} != {b}"
    left = sorted((tuple(plain(v) for v in r) for r in sr), key=repr)
    right = sorted((tuple(plain(v) for v in r) for r in dr), key=repr)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cols = [c for c, x, y in zip(sc, a, b) if x != y]
        return f"{len(bad)} of {len(left)} rows differ, first in {cols}: {[ (x,y) for x,y in zip(a,b) if x!=y]} key {a[:3]}"
    return None
