"""Run a query in Spark and its SQL in the checking database, and compare all rows."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame

DATA = "/root/testdata"


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> list:
    return [(v is None, str(v)) for v in row]


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    return columns, sorted(rows, key=_key)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    columns = sorted(names)
    rows = [tuple(r[names.index(c)] for c in columns) for r in cur.fetchall()]
    return columns, sorted(rows, key=_key)
