"""Run registered queries against their SQL answers and compare values exactly."""

from __future__ import annotations

import datetime
import decimal
import math
import time
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, float):
        return ("double", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", str(value))
    return (type(value).__name__, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def check(spark, sf_dir: str, build, sql: str, connection) -> tuple[bool, str, float]:
    """(equal, explanation, Spark seconds)."""
    started = time.time()
    frame = build(spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    seconds = time.time() - started
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} vs {sorted(names)}", seconds
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}", seconds
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        return False, f"{len(wrong)} rows differ, first {wrong[0]}", seconds
    return True, f"{len(got)} rows", seconds
