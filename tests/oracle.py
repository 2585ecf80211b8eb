"""Runs a query in Spark and its SQL in DuckDB and compares them value by value."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, int):
        v = float(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return _rows([d[0] for d in cur.description], cur.fetchall())


def difference(spark_side, duck_side):
    """None where equal, else a short account of what differs."""
    (ca, a), (cb, b) = spark_side, duck_side
    if ca != cb:
        return f"columns {ca} != {cb}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; only one side: {list(set(a) ^ set(b))[:4]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, such as {ca}: {bad[:2]}" if bad else None
