"""Small tables with every awkward row, and comparisons with DuckDB."""

from __future__ import annotations

import duckdb

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

#: id, text and columns whose names operators use themselves.
ROWS = [
    (1, "Same text here, twice over and over again.", 9, "a"),
    (2, "Same  text\nhere, twice over and over again.", 9, "a"),
    (2, "Same  text\nhere, twice over and over again.", 9, "a"),
    (3, None, None, None),
    (4, "", 0, ""),
    (5, LONG, 1, "b"),
    (6, LONG + " tail", 1, "b"),
    (None, "No id at all 12.34.56.78 but an address.", 1, "c"),
    (None, None, None, None),
    (7, "日本語 ünïcödé 😀 mail me: a.b@c-d.org now", 1, "c"),
]
FIELDS = "doc_id bigint, text string, kept int, label string"


def awkward(spark):
    return spark.createDataFrame(ROWS, FIELDS)


def empty(spark):
    return spark.createDataFrame([], FIELDS)


def table(sf_dir, name):
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()


def by_key(frame, key="doc_id"):
    return {row[key]: row for row in frame.collect()}
