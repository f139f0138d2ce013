"""Run queries on both engines and compare rows as unordered multisets."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0  # no tolerance; -0.0 equals 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    columns = df.columns
    return sorted(columns), rows_of(columns, [tuple(r) for r in df.collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
