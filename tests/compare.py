"""Run registered queries on Spark and DuckDB and compare whole results."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(_plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())
