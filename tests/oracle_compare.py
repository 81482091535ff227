"""Runs a query and its SQL on the same tables and compares the multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(_plain(v) for v in row) for row in rows)


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows
