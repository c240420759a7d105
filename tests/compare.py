"""Run a registered query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from '{path}'")
    return db


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def duckdb_rows(db, sql):
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)
