"""Comparison of a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types of values and rows agree."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(result.columns) != sorted(names):
        return [f"columns {sorted(result.columns)} != {sorted(names)}"]
    order = sorted(names)

    def bag(rows, columns):
        places = [columns.index(name) for name in order]
        return Counter(
            tuple((type(_plain(row[i])).__name__, _plain(row[i])) for i in places) for row in rows
        )

    ours = bag(result.collect(), result.columns)
    theirs = bag(expected.fetchall(), names)
    found = []
    if ours != theirs:
        for label, rest in (("only spark", ours - theirs), ("only sql", theirs - ours)):
            found += [f"{label} x{n}: {dict(zip(order, row, strict=True))}" for row, n in list(rest.items())[:3]]
        found.append(f"rows {ours.total()} / {theirs.total()}")
    return found
