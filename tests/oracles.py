"""Comparison of a query's rows with those of its SQL."""

import os

import pandas as pd

DATA = "/root/testdata/sf0.001"


def connection(folder=DATA):
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in os.listdir(folder):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return con


def cell(value):
    if pd.isna(value) is True:
        return "NULL"
    return f"{value:.6g}" if isinstance(value, float) else str(value)


def rows_of(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1)
    return sorted(tuple(cell(v) for v in r) for r in frame.astype(object).itertuples(index=False))


def assert_same(df, con, sql):
    ours, theirs = df.toPandas(), con.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
