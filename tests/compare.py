"""Runs queries and their checking SQL on the same tables and compares all rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(normal(row[i]) for i in order) for row in rows)


def spark_rows(frame) -> tuple[list[str], Counter]:
    return rows_of(frame.columns, [tuple(row) for row in frame.collect()])


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    return rows_of([column[0] for column in result.description], result.fetchall())
