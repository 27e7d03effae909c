"""Runs of repeated words against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SF_TINY, awkward, empty, table

from ledgerlens.llm import periodic, queries


def plain_runs(words, shortest=12):
    """Every run by comparing the words with themselves at every distance."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > at and end + period - at >= 2 * period:
                found.setdefault((at, end + period), period)
            at = max(end, at + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= shortest)


def _shifted_periods(draw):
    root = [str(draw.randrange(2)) for _ in range(draw.randint(2, 5))]
    words = []
    for _ in range(draw.randint(2, 5)):
        turn = draw.randrange(len(root))
        words += (root * 40)[turn : turn + draw.randint(10, 90)]
    return words


def _broken_repeats(draw):
    block = [str(draw.randrange(4)) for _ in range(draw.randint(1, 40))]
    words = (block * 30)[: draw.randint(0, 250)]
    for _ in range(draw.randint(0, 3)):
        if words:
            words[draw.randrange(len(words))] = "x"
    return words


def _powers_of_powers(draw):
    words = []
    for _ in range(draw.randint(1, 4)):
        words += [str(draw.randrange(3)) for _ in range(draw.randint(1, 12))] * draw.randint(1, 10)
    return words * draw.randint(1, 3)


def _fibonacci(draw):
    last, words = ["a"], ["a", "b"]
    for _ in range(draw.randint(3, 9)):
        last, words = words, words + last
    return words[draw.randint(0, 5) :][:260]


def _random_words(draw):
    kinds = draw.choice([1, 2, 2, 3, 30])
    return [str(draw.randrange(kinds)) for _ in range(draw.randint(0, 140))]


@pytest.mark.parametrize(
    "kind", [_shifted_periods, _broken_repeats, _powers_of_powers, _fibonacci, _random_words]
)
def test_equals_plain_search(kind):
    draw = random.Random(7)
    for _ in range(15):
        texts = [kind(draw) for _ in range(12)]
        found = periodic.runs_of(texts)
        for words, runs in zip(texts, found, strict=True):
            assert [tuple(run) for run in runs.tolist()] == plain_runs(words)


def test_regions_without_members_need_their_shift():
    # The first period is itself (a b)^6 a: no synchronising place, only the phase shift proposes 13.
    words = ["a", "b"] * 6 + ["a"]
    runs = periodic.runs_of([words + words])[0].tolist()
    assert [0, 26, 13] in runs and sorted(map(tuple, runs)) == plain_runs(words + words)


def test_synchronising_sets_repeat_with_their_words():
    draw = random.Random(3)
    words = [draw.randrange(6) for _ in range(400)]
    codes = np.array(words + [-1] + words)
    names = periodic._Names(codes, 0)
    none = np.zeros((0, 3), dtype=np.int64)
    for k in (2, 3, 4):
        members = set(periodic.synchronising_set(names, none, k).tolist())
        inside = {at for at in members if at + 2 * (1 << k) <= 400}
        assert inside and inside == {at - 401 for at in members if at >= 401}
        gaps = np.diff(sorted(inside))
        assert gaps.max() <= 1 << k


def test_very_long_texts_in_linear_steps():
    words = [str(at % 15) if at % 1000 else "x" for at in range(300_000)]
    runs = periodic.runs_of([words, ["a"] * 300_000])
    assert runs[1].tolist() == [[0, 300_000, 1]]
    assert [0, 300_000, 3000] in runs[0].tolist() and len(runs[0]) == 301


def test_misleading_hashes_are_noticed(monkeypatch):
    """With names that take all words for equal, the check of the runs asks for others."""
    honest, salts = periodic._mixed, []

    class Misled(periodic._Names):
        def __init__(self, codes, salt):
            salts.append(salt)
            super().__init__(codes // 2 if salt == 0 else codes, salt)

    monkeypatch.setattr(periodic, "_Names", Misled)
    draw = random.Random(1)
    words = [str(draw.randrange(40)) for _ in range(15)] * 2 + [str(n) for n in range(50)]
    words[20] = "changed"
    assert [tuple(run) for run in periodic.runs_of([words])[0].tolist()] == plain_runs(words)
    assert honest is periodic._mixed and salts[0] == 0


def test_awkward_rows(spark):
    rows = periodic.periodic_runs(awkward(spark)).collect()
    assert len(rows) == 10
    for row in rows:
        assert (row["n_words"] == 0) == (row["collapsed"] == "")
    assert sum(row["doc_id"] is None for row in rows) == 2
    found = periodic.periodic_runs(empty(spark))
    assert found.collect() == [] and found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    clash = spark.createDataFrame(
        [(1, "a b " * 8, 5, [1], "z")], "doc_id int, text string, n_words int, runs array<int>, _text string"
    )
    (row,) = periodic.periodic_runs(clash).collect()
    assert [tuple(run) for run in row["runs"]] == [(0, 16, 2)] and row["collapsed"] == "a b"


def test_query_equals_plain_python(spark):
    word = re.compile(periodic.WORD)
    got = {row["doc_id"]: row for row in queries.op13_periodic_runs(spark, SF_TINY).collect()}
    docs = table(SF_TINY, "documents")
    assert got.keys() == {row[0] for row in docs}
    planted = 0
    for doc_id, text, *_ in docs:
        words = word.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[at] if at < a else words[a + (at - a) % p] for at in range(n)]
            planted += 1
        row = got[doc_id]
        if n > 1500:  # the plain search is quadratic
            continue
        runs = plain_runs(words)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        dropped = {at for s, length, q in runs for at in range(s + q, s + length)}
        kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
        best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert planted
