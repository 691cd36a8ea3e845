"""Runs a query and its SQL and compares the rows."""

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder):
    c = duckdb.connect()
    for t in TABLES.split():
        path = f"{folder}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    return 0.0 if isinstance(v, float) and v == 0 else v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


def assert_equal(df, connection, sql):
    result = connection.execute(sql)
    names = [x[0] for x in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())
