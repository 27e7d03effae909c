from __future__ import annotations

import numpy as np
import pytest

from ledgerlens.llm import embeddings

FIELDS = "vec_id bigint, embedding array<float>, label int, kept string, cell int"


def _brute(rows, least=0.98):
    usable = {}
    for at, (key, vector, label, *_) in enumerate(rows):
        if key is None or label is None or not vector:
            continue
        if any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        usable[at] = np.asarray(vector, dtype=np.float32).astype(np.float64)
    links = {at: [] for at in range(len(rows))}
    for a, x in usable.items():
        for b, y in usable.items():
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a].append(b)
    found = []
    for at, row in enumerate(rows):
        seen, work = {at}, [at]
        while work:
            for other in links[work.pop()]:
                if other not in seen:
                    seen.add(other)
                    work.append(other)
        component = min((rows[i][0] for i in seen if rows[i][0] is not None), default=None)
        found.append((row[0], len(links[at]), component, component == row[0]))
    return sorted(found, key=repr)


def _rows():
    rng = np.random.default_rng(3)
    rows = []
    centres = rng.normal(size=(6, 8))
    for key in range(400):
        spread = rng.choice([0.02, 0.06, 1.0])
        vector = centres[key % 6] + rng.normal(size=8) * spread
        rows.append((key, [float(np.float32(x)) for x in vector], int(key % 3), "x", 1))
    copy = rows[7][1]
    rows += [(1000 + i, copy, rows[7][2], "x", 1) for i in range(30)]
    rows += [
        (2000, None, 1, "x", 1),
        (2001, [], 1, "x", 1),
        (2002, [0.0] * 8, 1, "x", 1),
        (2003, [None, *copy[1:]], 1, "x", 1),
        (2004, [float("nan"), *copy[1:]], 1, "x", 1),
        (2005, [float("inf"), *copy[1:]], 1, "x", 1),
        (2006, copy, None, None, None),
        (2007, [2 * x for x in copy], rows[7][2], "x", 1),
        (2008, [-0.0, 1.0], 0, "x", 1),
        (2009, [0.0, 1.0], 0, "x", 1),
    ]
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{}, {"cell_rows": 10}, {"cell_rows": 10, "block_rows": 7}, {"cell_rows": 40, "most_pivots": 4}],
)
def test_equals_comparing_all(spark, sizes):
    rows = _rows()
    frame = spark.createDataFrame(rows, FIELDS).repartition(3)
    found = embeddings.near_vectors(frame, **sizes).collect()
    got = sorted(
        ((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found), key=repr
    )
    assert got == _brute(rows)


def test_rows_without_key_and_repeated_rows(spark):
    rows = [(None, [1.0, 0.0], 1, "x", 1), (4, [1.0, 0.0], 1, "x", 1), (4, [1.0, 0.0], 1, "x", 1)]
    found = embeddings.near_vectors(spark.createDataFrame(rows, FIELDS)).collect()
    assert sorted((repr(r["vec_id"]), r["n_links"], r["kept"]) for r in found) == [
        ("4", 1, True), ("4", 1, True), ("None", 0, True),
    ]


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], FIELDS)).count() == 0
