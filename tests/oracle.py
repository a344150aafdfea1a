"""Comparing a Spark result with the same query run by DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9) if math.isfinite(value) else str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_result(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
