"""Runs a query and its SQL over one folder and compares rows without regard to order."""

import glob
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def compare(spark, query, sql: str, folder: str = DATA) -> None:
    got = query(spark, folder)
    cursor = connect(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(names) == sorted(got.columns)
    got = [tuple(r[n] for n in names) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
