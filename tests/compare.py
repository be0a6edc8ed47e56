"""Compare a Spark result with DuckDB's, whatever the row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    return value


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    result = con.execute(sql)
    return normalised([d[0] for d in result.description], result.fetchall())
