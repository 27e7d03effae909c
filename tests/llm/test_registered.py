"""The registered queries: SQL answers where there are any, and the pipeline stage by stage."""

from __future__ import annotations

import re
import zlib

import corpus_pipeline
import pytest
from helpers import SF_TINY

import __spark_entry__ as entry_points
from ledgerlens.llm import packing, queries
from oracle.compare import check, connect


@pytest.mark.parametrize("name", sorted(queries.answers()))
def test_query_equals_sql(spark, name):
    with connect(SF_TINY) as connection:
        equal, note, _ = check(
            spark, SF_TINY, queries.all_queries()[name], queries.answers()[name], connection
        )
    assert equal, note


def test_all_are_registered():
    named = entry_points.queries()
    assert {"pipeline", *queries.all_queries()} <= set(named)
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.all_queries()]
    assert numbers == list(range(1, 14))


def test_toxicity_query(spark):
    rows = queries.op2_toxicity(spark, SF_TINY).collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    columns, previous = docs.columns, {row["doc_id"]: row for row in docs.collect()}
    first = previous
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, SF_TINY).write.parquet(path)
        docs = spark.read.parquet(path)
        if at == len(corpus_pipeline.STAGES) - 1:
            break
        assert docs.columns == columns
        rows = {row["doc_id"]: row for row in docs.collect()}
        assert rows.keys() <= previous.keys()
        if name == "exact_dedup":
            norm = lambda row: re.sub(r"[\x20\x09-\x0D]+", " ", row["text"])
            smallest = {}
            for row in sorted(previous.values(), key=lambda row: row["doc_id"]):
                smallest.setdefault(norm(row), row["doc_id"])
            assert rows.keys() == set(smallest.values())
        if name == "personal_data":
            assert rows.keys() == previous.keys()
            assert all(row["n_chars"] == len(row["text"]) for row in rows.values())
        else:
            assert all(rows[key] == previous[key] for key in rows)
        previous = rows
    assert len(previous) > 0.5 * len(first)
    assert {row["doc_id"] for row in docs.collect()} == previous.keys()
    assert max(row["offset"] + row["length"] for row in docs.collect()) <= packing.WINDOW


def test_personal_data_stage_keeps_a_column_of_its_own_name(spark):
    docs = spark.createDataFrame(
        [(1, "mail a.b@c.org now", 18, "mine")], "doc_id bigint, text string, n_chars bigint, pii_spans string"
    )
    (row,) = corpus_pipeline.mask_personal_data(spark, docs, SF_TINY).collect()
    assert row["pii_spans"] == "mine" and "a.b@c.org" not in row["text"] and row["n_chars"] == len(row["text"])
