"""Compare a query with its SQL: same columns, same rows whatever their order."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def spark_rows(df):
    return _ordered(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _ordered(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, otherwise what differs first."""
    columns, rows = spark_rows(df)
    expected_columns, expected = sql_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)} rows; first {rows[:2]} / {expected[:2]}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ; first {wrong[0][0]} != {wrong[0][1]}"
    return None
