"""Compare a Spark result with the result of its SQL counterpart."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((cell is None, str(cell)) for cell in row))


def difference(frame, connection, sql: str) -> str | None:
    """None if both give the same columns and rows, else a description."""
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    expected = _rows(columns, result.fetchall())
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
