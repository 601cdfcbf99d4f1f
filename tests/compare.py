"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(directory: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def multiset(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    """None when both results are equal, else a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = multiset(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    wanted = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    wrong = {n: (t, types[n]) for n, t in frame.dtypes if wanted.get(t, t) != types[n]}
    actual = multiset(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    if actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    return f"types {wrong}" if wrong else None
