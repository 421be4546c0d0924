"""Side-by-side run of a query and its SQL counterpart."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals must not reach a result")
    if isinstance(value, datetime.datetime):
        raise TypeError("timestamps must not reach a result")
    return value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
