"""Run a query and its SQL on the same tables and compare names, types and values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0  # -0.0 -> 0.0
    return value


def differences(df, connection, sql: str) -> list[str]:
    """What differs, in words; an empty list if nothing does."""
    cursor = connection.execute(sql)
    theirs = {d[0]: i for i, d in enumerate(cursor.description)}
    their_types = {
        name: kind for name, kind, *_ in connection.execute(f"DESCRIBE {sql}").fetchall()
    }
    cursor = connection.execute(sql)
    names = sorted(df.columns)
    if names != sorted(theirs):
        return [f"columns {names} against {sorted(theirs)}"]
    found = []
    for name in names:
        ours, other = dict(df.dtypes)[name], their_types[name]
        if ours != _TYPES.get(str(other), str(other)):
            found.append(f"{name}: {ours} against {other}")
    a = sorted(
        (tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_sort_key
    )
    b = sorted(
        (tuple(_plain(r[theirs[n]]) for n in names) for r in cursor.fetchall()), key=_sort_key
    )
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
