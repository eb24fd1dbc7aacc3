"""Compare a query's rows with its oracle SQL, which DuckDB runs on the same Parquet files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if columns and rows agree; otherwise what differs, with a few sample rows."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    mine, theirs = _bag(df.columns, df.collect()), _bag(names, expected.fetchall())
    if mine == theirs:
        return []
    extra, missing = mine - theirs, theirs - mine
    return [
        f"{sum(mine.values())} rows against {sum(theirs.values())}",
        *[f"unexpected {row}" for row in list(extra)[:3]],
        *[f"missing {row}" for row in list(missing)[:3]],
    ]
