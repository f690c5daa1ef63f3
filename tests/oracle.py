"""Compare a Spark result with DuckDB SQL on the same parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)
