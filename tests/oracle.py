"""Compares a query with its SQL the way any order-blind checker would: by names and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(flat, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return sorted_rows([c[0] for c in cur.description], cur.fetchall())
