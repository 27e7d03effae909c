from __future__ import annotations

import hashlib
import re

import pytest
from helpers import ROWS, awkward, empty

from ledgerlens.llm import exact_dedup


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("hash_bits", [64, 1])
def test_equals_plain_grouping(spark, hash_bits):
    """With one hash bit nearly all chunks collide and their texts must decide."""
    found = exact_dedup.exact_duplicates(awkward(spark), hash_bits=hash_bits).collect()
    groups = {}
    for doc, text, *_ in ROWS:
        groups.setdefault(_norm(text), []).append(doc)
    assert len(found) == len(ROWS)
    digests = {hashlib.sha256(text.encode()).hexdigest(): ids for text, ids in groups.items()}
    for row in found:
        ids = digests[row["text_sha256"]]
        keyed = [i for i in ids if i is not None]
        assert row["group_size"] == len(ids)
        assert row["keep_id"] == (min(keyed) if keyed else None)
    for digest, ids in digests.items():
        kept = [row["doc_id"] for row in found if row["text_sha256"] == digest and row["kept"]]
        assert len(kept) == 1
        assert kept[0] == min((i for i in ids if i is not None), default=None)


def test_keep_first_keeps_columns_and_one_row_a_group(spark):
    kept = exact_dedup.keep_first(awkward(spark))
    assert kept.columns == ["doc_id", "text", "kept", "label"]
    texts = [_norm(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted({_norm(text) for _, text, *_ in ROWS})


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


def test_chunks_rebuild_the_text(spark):
    from pyspark.sql import functions as F

    frame = awkward(spark).select(exact_dedup.normalised("text").alias("t"))
    parts = exact_dedup.chunks(F.col("t"))
    assert frame.where(F.array_join(parts, "") != F.col("t")).count() == 0
    long = frame.where(F.length("t") > 100_000).select(F.max(F.size(parts))).first()[0]
    assert long > 20


def test_no_python_in_plan(spark):
    plan = exact_dedup.exact_duplicates(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
