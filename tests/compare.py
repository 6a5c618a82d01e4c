"""Compares a query with its SQL twin on the same tables."""

import math
import os

import duckdb


def rows(table, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda x: ("nan" if math.isnan(x) else repr(round(x, 9) + 0.0)) if isinstance(x, float) else str(x)
    return sorted(tuple(text(r[i]) for i in order) for r in table)


def assert_same(spark, query, sql, data):
    db = duckdb.connect()
    for f in os.listdir(data):
        db.execute(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    df = query(spark, data)
    found = db.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(found.fetchall(), columns)
