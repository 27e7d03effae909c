from __future__ import annotations

from collections import Counter

import pytest
from helpers import SF_TINY, awkward, empty, table

from ledgerlens.llm import suffix_dedup


def brute(texts, length):
    """(kept bytes, runs) of every text, by counting all strings of the length."""
    seen = Counter(
        text[at : at + length] for text in texts for at in range(len(text) - length + 1)
    )
    found = []
    for text in texts:
        runs = []
        for at in range(len(text) - length + 1):
            if seen[text[at : at + length]] > 1:
                if runs and at <= runs[-1][1]:
                    runs[-1][1] = at + length
                else:
                    runs.append([at, at + length])
        edges = [0, *(edge for run in runs for edge in run), len(text)]
        found.append((b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), runs))
    return found


def _check(spark, texts, length):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = suffix_dedup.repeated_strings(frame, length).orderBy("doc_id").collect()
    raw = [(text or "").encode() for text in texts]
    for row, data, (kept, runs) in zip(rows, raw, brute(raw, length), strict=True):
        assert row["n_bytes"] == len(data)
        assert [[span["start"], span["end"]] for span in row["removed"]] == runs
        assert bytes(row["kept"]) == kept


@pytest.mark.parametrize("length", [16, 50, 200])
def test_equals_counting_on_hard_cases(spark, length):
    unit = "".join(chr(97 + (i * i + 3 * i) % 26) for i in range(300))
    texts = [
        "a" * 700,
        "ab" * 300,
        unit + "x" + unit[:150],
        "prefix one " + unit[40:260] + " tail",
        "other " + unit[60:280] + "!",
        unit[100:130] + "é" * 120,
        "é" * 130,
        None,
        "",
        "short",
        "Z" * (length - 1),
        "Q" * length,
        "Q" * length,
    ]
    _check(spark, texts, length)


def test_parts_of_long_texts(spark, monkeypatch):
    """Texts longer than a part are cut with overlap and give the same runs."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 97)
    unit = "".join(chr(97 + (i * 7 + i // 5) % 26) for i in range(400))
    parts = suffix_dedup._parts
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([unit.encode()])], names=["row", "_text"]
    )
    covered = set()
    for some in parts(batch, 50):
        for _, offset, data in some:
            for at in range(len(data) - 49):
                assert offset + at not in covered
                covered.add(offset + at)
                assert unit.encode()[offset + at : offset + at + 50] == data[at : at + 50]
    assert covered == set(range(len(unit) - 49))


def test_equals_counting_on_documents(spark):
    _check(spark, [row[1] for row in table(SF_TINY, "documents")], 200)


def test_awkward_rows(spark):
    rows = suffix_dedup.repeated_strings(awkward(spark)).collect()
    assert len(rows) == 10
    long = {row["doc_id"]: row for row in rows}
    assert bytes(long[5]["kept"]) == b"" and bytes(long[6]["kept"]) == b" tail"
    assert suffix_dedup.repeated_strings(empty(spark)).count() == 0
