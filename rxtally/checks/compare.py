"""Compare a query's rows with the rows of its SQL, column by column."""

from __future__ import annotations

import math
from pathlib import Path

import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def _rows(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_plain(row[k]) for k in order) for row in rows), key=repr)


def difference(df, connection, sql: str) -> str | None:
    """First difference between a DataFrame and the SQL's answer, or None."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = _rows(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    found = _rows([tuple(row) for row in df.collect()], df.columns)
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    for mine, theirs in zip(found, expected, strict=True):
        if mine != theirs:
            return f"{sorted(names)}: {mine} against {theirs}"
    return None
