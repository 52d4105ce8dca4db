"""Runs registered queries beside their DuckDB counterparts and compares the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, connection, sql: str) -> list[str]:
    result = connection.execute(sql)
    expected_columns = [c[0] for c in result.description]
    expected = _sorted_rows(expected_columns, result.fetchall())
    found = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if sorted(expected_columns) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}")
    if len(expected) != len(found):
        problems.append(f"{len(found)} rows != {len(expected)}")
    problems += [f"{a} != {b}" for a, b in zip(found, expected, strict=False) if a != b][:3]
    return problems
