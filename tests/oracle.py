"""Comparison of a query with its SQL oracle."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A database whose views are the parquet tables of ``folder``."""
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    """A value in a form both engines share, with its kind."""
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("f", value)
    if isinstance(value, Decimal):
        return ("d", value.normalize())
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, list):
        return ("l", tuple(plain(v) for v in value))
    return (type(value).__name__, value)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    """Rows with columns sorted by name, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or ``None``."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}: {actual[:2]} / {expected[:2]}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None
