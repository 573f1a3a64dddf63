"""Run a registered query and its SQL twin, and compare rows regardless of order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return [item[0] for item in cursor.description], cursor.fetchall()


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    return frame.columns, [tuple(row) for row in frame.collect()]


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)
