"""Run a registered query in Spark and its SQL in DuckDB, compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normalized(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normalized(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    found = connection.execute(sql)
    columns = [item[0] for item in found.description]
    return sorted(columns), normalized(columns, found.fetchall())
