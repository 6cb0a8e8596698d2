"""Comparing a query with its SQL."""

import glob
import os

import duckdb


def connection(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(repr, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


def same(con, sql, frame):
    expected, got = con.sql(sql).df(), frame.toPandas()
    assert sorted(expected.columns) == sorted(got.columns)
    assert rows(expected) == rows(got)
