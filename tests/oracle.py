"""Runs SQL on the given tables in DuckDB and brings results of both engines to one form."""

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    return value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), v) for v in r),
    )


def sql_rows(con, text):
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    return sorted(names), normal(cur.fetchall(), names)


def spark_rows(df):
    return sorted(df.columns), normal([tuple(r) for r in df.collect()], df.columns)
