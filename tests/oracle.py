"""Compare a Spark result with DuckDB's answer on the same Parquet files."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# DuckDB type -> Spark type that holds the same values.
SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        if (Path(sf_dir) / f"{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def assert_same(result: DataFrame, connection, sql: str) -> int:
    """Same columns, types and multiset of rows; returns the row count."""
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    columns = sorted(result.columns)
    assert columns == sorted(described), (columns, sorted(described))
    types = dict(result.dtypes)
    wrong = {c: (types[c], described[c]) for c in columns if SPARK_TYPES.get(described[c]) != types[c]}
    assert not wrong, wrong
    order = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(tuple(map(_cell, row)) for row in connection.execute(f"SELECT {order} FROM ({sql})").fetchall())
    actual = sorted(tuple(map(_cell, row)) for row in result.select(*columns).collect())
    assert len(actual) == len(expected), (len(actual), len(expected))
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, differing[:3]
    return len(actual)
