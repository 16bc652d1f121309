"""Run a registered query and its SQL counterpart and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(cell):
    if cell is None or (isinstance(cell, float) and math.isnan(cell)):
        return (0, "")
    if isinstance(cell, bool):
        return (1, str(cell))
    if isinstance(cell, (int, float, decimal.Decimal)):
        return (2, float(cell))
    if isinstance(cell, dt.datetime):
        return (3, cell.isoformat())
    if isinstance(cell, dt.date):
        return (4, cell.isoformat())
    return (5, str(cell))


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def differences(spark_df, connection, sql: str, may_be_empty: bool = False) -> list[str]:
    """Human-readable differences; empty when columns, types, row count and values agree."""
    result = connection.sql(sql)
    found = []
    if sorted(spark_df.columns) != sorted(result.columns):
        return [f"columns differ: {sorted(spark_df.columns)} vs {sorted(result.columns)}"]
    kinds = dict(zip(result.columns, map(str, result.types)))
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != kinds[name] and '"NULL"' != kinds[name]:
            found.append(f"type of {name}: {kind} vs {kinds[name]}")
    ours = _canonical(spark_df.columns, spark_df.collect())
    theirs = _canonical(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} vs {len(theirs)}")
    if not ours and not may_be_empty:
        found.append("no rows")
    for a, b in zip(ours, theirs):
        if a != b:
            names = sorted(spark_df.columns)
            found.append("first difference: " + "; ".join(
                f"{n}: {x[1]!r} vs {y[1]!r}" for n, x, y in zip(names, a, b) if x != y))
            break
    return found
