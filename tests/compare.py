"""Rows of Spark and of DuckDB in one form."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(r[i]) for i in order] for r in data), key=repr)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_duckdb(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.sql(sql)
    return rows(list(found.columns), found.fetchall())
