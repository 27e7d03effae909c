"""Licence scans against plain Python on whole tables and on altered notices."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from helpers import SF_SMALL, SF_TINY, awkward, empty, table

from ledgerlens.llm import licenses, queries

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def plain_places(words):
    """(start, label) of every phrase, by looking at every word."""
    found = []
    for phrase, label in licenses.PHRASES:
        wanted = phrase.split()
        found += [(at, label) for at in range(len(words)) if words[at : at + len(wanted)] == wanted]
    return sorted(found)


def plain_notices(words, weight):
    """(start, label, share) of every notice, by trying every place."""
    found = []
    for template in licenses.templates():
        if template.is_phrase:
            continue
        wanted = [word.decode() for word in template.words]
        size, total = len(wanted), sum(weight[word] for word in wanted)
        numbers = {word: at for at, word in enumerate(sorted(weight, key=str.encode))}
        posted = sorted(range(size), key=lambda at: (-weight[wanted[at]], numbers[wanted[at]], at))
        for start in range(-size, len(words)):
            held = [0 <= start + at < len(words) and words[start + at] == wanted[at] for at in range(size)]
            agreeing = sum(held[at] for at in posted[: licenses.POSTED])
            share = sum(weight[wanted[at]] for at in range(size) if held[at]) / total
            mandatory = all(all(held[first : first + n]) for first, n in template.mandatory)
            if mandatory and agreeing >= min(licenses.AGREEING, size) and share >= licenses.SHARE:
                found.append((start, template.label, round(share, 9)))
    return sorted(found)


def plain_weights(texts):
    """Weight of every licence word by the rows that hold it."""
    vocabulary = {word.decode() for word in licenses.vocabulary(licenses.templates())}
    held = [vocabulary & set(plain_words(text)) for text in texts]
    return {
        word: math.log((1 + len(texts)) / (1 + sum(word in some for some in held))) + 1 for word in vocabulary
    }


@pytest.mark.parametrize("sf_dir", [SF_TINY, SF_SMALL])
def test_base_columns_equal_plain_search(spark, sf_dir):
    got = {row["doc_id"]: row for row in queries.op12_license_scan(spark, sf_dir).collect()}
    docs = table(sf_dir, "documents")
    assert got.keys() == {row[0] for row in docs}
    found = 0
    for doc_id, text, *_ in docs:
        words, row = plain_words(text), got[doc_id]
        places = plain_places(words)
        assert row["n_words"] == len(words) and row["n_base"] == len(places)
        assert row["first_word"] == min((at for at, _ in places), default=None)
        assert row["last_word"] == max((at for at, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["labels"] != "")
        found += len(places)
    assert found or sf_dir == SF_TINY


def _altered(notice, seed):
    draw = np.random.default_rng(seed)
    words = notice.split()
    for at in draw.integers(0, len(words), len(words) // 8):
        words[at] = "altered"
    return " ".join(words)


def _texts():
    plain = [notice for _, notice, _ in licenses.NOTICES]
    texts = ["nothing of the kind", None, "", "Cc\tby cc-BY mité license MIT--License"]
    for at, notice in enumerate(plain):
        texts.append(f"Preface number {at}. {notice}. And more.")
        texts.append(_altered(notice, at))
        texts.append(notice[: int(len(notice) * 0.8)])
        texts.append(notice[len(notice) // 3 :])
    # Text ends where a notice would go on in the next row.
    half = plain[3].split()
    texts += [" ".join(half[:20]), " ".join(half[20:])]
    texts.append(" ".join(plain) + " x" * 3000 + " " + " ".join(reversed(plain)))
    return texts


def test_notices_equal_plain_search(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    weight = plain_weights(texts)
    found = {row["doc_id"]: row["found"] for row in licenses.find_licenses(docs).collect()}
    labels = set()
    for number, text in enumerate(texts):
        words = plain_words(text)
        got = sorted((m["start"], m["label"], round(m["share"], 9)) for m in found[number] if not m["is_phrase"])
        assert got == plain_notices(words, weight), text
        assert sorted((m["start"], m["label"]) for m in found[number] if m["is_phrase"]) == plain_places(words)
        labels |= {label for _, label, _ in got}
    assert labels == {label for label, _, _ in licenses.NOTICES}


def test_result_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id int, text string")
    one, many = (
        sorted(map(str, licenses.find_licenses(docs.repartition(parts)).collect())) for parts in (1, 7)
    )
    assert one == many


def test_awkward_rows(spark):
    rows = licenses.find_licenses(awkward(spark)).collect()
    assert len(rows) == 10 and sum(row["doc_id"] is None for row in rows) == 2
    assert all(row["found"] == [] for row in rows)
    found = licenses.find_licenses(empty(spark))
    assert found.collect() == [] and found.columns == ["doc_id", "n_words", "found"]
    clash = spark.createDataFrame(
        [(1, "MIT License", 4, "f", "t")], "doc_id int, text string, n_words int, found string, _text string"
    )
    (row,) = licenses.find_licenses(clash).collect()
    assert row["n_words"] == 2 and [m["label"] for m in row["found"]] == ["mit"]
