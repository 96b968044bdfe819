"""Compare a query with its SQL counterpart in DuckDB, whatever the order of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value: object) -> object:
    """A value that compares by type as well: 1 is not 1.0."""
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (int, float, decimal.Decimal)):
        return type(value).__name__, value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return type(value).__name__, value.isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    expected = connection.execute(sql)
    columns = [item[0] for item in expected.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(columns)}"
    want, got = rows_of(columns, expected.fetchall()), rows_of(result.columns, result.collect())
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {str(a)[:300]} instead of {str(b)[:300]}"
    return None
