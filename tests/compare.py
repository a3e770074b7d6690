"""Run registered queries beside their SQL and compare schema kinds and rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of_spark(df) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    kinds = [dict(df.dtypes)[n] for n in names]
    rows = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    return names, kinds, rows


_KINDS = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def rows_of_duck(connection, sql: str) -> tuple[list[str], list[str], Counter]:
    cursor = connection.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    fetched = cursor.fetchall()
    names = [described[i][0] for i in order]
    kinds = [_KINDS.get(described[i][1], described[i][1]) for i in order]
    return names, kinds, Counter(tuple(_plain(r[i]) for i in order) for r in fetched)
