from __future__ import annotations

import numpy as np
import pytest
import xxhash
from helpers import SF_TINY, awkward, empty, table

import corpus_pipeline
from ledgerlens.llm import simhash


def _components(count, links):
    parent = list(range(count))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(at) for at in range(count)]


def _plain(text, words=3):
    found = text.encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("count", [3, 60, 1500])
@pytest.mark.parametrize("radius", [1, 3])
def test_tree_links_what_is_near(count, radius):
    rng = np.random.default_rng(count)
    centres = rng.integers(0, 1 << 63, 4)
    values = np.unique(
        np.array(
            [
                int(centres[rng.integers(4)]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(7), False))
                for _ in range(count)
            ],
            dtype=np.uint64,
        )
    )
    near = [
        (i, int(j))
        for i in range(len(values))
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius) + i + 1
    ]
    links = simhash.near_links(values, radius)
    assert len(links) < len(values)
    assert set(links) <= {pair for a, b in near for pair in ((a, b), (b, a))}
    assert _components(len(values), links) == _components(len(values), near)


def test_bit_totals():
    hashes = np.random.default_rng(1).integers(0, 1 << 64, 1001, dtype=np.uint64)
    plain = [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    assert simhash._bit_totals(hashes[None, :]).tolist() == [plain]
    rows = simhash._bit_totals(np.stack([hashes, hashes[::-1] ^ np.uint64(1)]))
    assert rows[0].tolist() == plain and rows[1][1:].tolist() == plain[1:]
    assert rows[1][0] == len(hashes) - plain[0]


@pytest.mark.parametrize("shard", [8192, 5])
def test_equals_comparing_all(spark, shard):
    """A shard of five divides the crowded keys and searches their parts pairwise."""
    docs = [(row[0], row[1]) for row in table(SF_TINY, "documents")]
    base = "one two three four five six seven eight nine ten eleven twelve " * 20
    docs += [(10_000 + i, base + f"w{i % 7} " * (i % 3)) for i in range(40)]
    values = np.array([_plain(text or "") for _, text in docs], dtype=np.uint64)
    near = [
        (i, int(j))
        for i in range(len(docs))
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1
    ]
    root = _components(len(docs), near)
    smallest = {}
    for at, (doc, _) in zip(root, docs):
        smallest[at] = min(doc, smallest.get(at, doc))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = simhash.near_duplicates(frame, shard=shard).collect()
    got = {row["doc_id"]: (row["fp"] % (1 << 64), row["component_id"]) for row in found}
    assert got == {
        doc: (int(value), smallest[at]) for (doc, _), value, at in zip(docs, values, root)
    }


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 10
    by_id = {row["doc_id"]: row for row in rows if row["doc_id"] is not None}
    assert by_id[3]["fp"] == by_id[4]["fp"] == 0
    assert by_id[4]["component_id"] == 3 and by_id[2]["component_id"] == 1
    assert all(row["component_id"] is None for row in rows if row["doc_id"] is None)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_similar_documents_catch_edits_and_leave_others(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    texts, groups = [], []
    for group in range(40):
        text = [words[i] for i in rng.integers(0, 4000, 200)]
        for _ in range(3):
            edited = list(text)
            for at in rng.choice(200, 2, False):
                edited[at] = words[rng.integers(4000)]
            texts.append(" ".join(edited))
            groups.append(group)
    frame = spark.createDataFrame(
        list(zip(range(len(texts)), texts, groups)), "doc_id long, text string, truth int"
    )
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    counts = [0] * 40
    for row in kept.collect():
        counts[row["truth"]] += 1
    assert min(counts) == 1 and sum(counts) <= 44


def test_keep_one_awkward(spark):
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == ["doc_id", "text", "kept", "label"]
    texts = [row["text"] for row in kept.collect()]
    assert texts.count(None) == 2 and "" in texts
    assert simhash.keep_one(empty(spark)).count() == 0


def _shingles(text, words=5):
    found = text.split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def _jaccard(one, other):
    a, b = _shingles(one), _shingles(other)
    return len(a & b) / len(a | b)


def test_similar_documents_find_isolated_block_edits(spark):
    """Pairs whose difference is one passage, added, removed or replaced, around 0.75 to 0.9."""
    rng = np.random.default_rng(11)
    texts = []
    for pair in range(240):
        text = [f"p{pair}w{i}" for i in rng.integers(0, 4000, 404)]
        other, size, at = list(text), int(rng.integers(15, 110)), int(rng.integers(0, 290))
        fresh = [f"p{pair}x{i}" for i in range(size)]
        if pair % 3 == 0:
            other = other + fresh
        elif pair % 3 == 1:
            del other[at : at + size]
        else:
            other[at : at + size // 2] = fresh[: size // 2]
        texts += [" ".join(text), " ".join(other)]
    alike = [_jaccard(a, b) >= 0.8 for a, b in zip(texts[::2], texts[1::2])]
    assert 60 < sum(alike) < 220
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {row["doc_id"] for row in simhash.keep_one(frame).collect()}
    assert [2 * pair + 1 not in kept for pair in range(240)] == alike


@pytest.mark.parametrize("part_rows", [512, 4])
def test_similar_groups_equal_comparing_all(spark, part_rows):
    """Parts of four divide every group and compare the pieces block by block; repeats count once."""
    rng = np.random.default_rng(12)
    texts = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(120)]
        for number in range(30):
            text, size = list(base), int(rng.integers(0, 26))
            at = int(rng.integers(0, 120 - size))
            text[at : at + size] = [f"g{group}n{number % 9}x{i}" for i in range(size)]
            texts.append(" ".join(text + text[:40] * (number % 3)))
    near = [
        (i, j) for i in range(len(texts)) for j in range(i) if _jaccard(texts[i], texts[j]) >= 0.8
    ]
    root = _components(len(texts), near)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {row["doc_id"] for row in simhash.keep_one(frame, part_rows=part_rows).collect()}
    assert kept == set(root)


def test_pipeline_stage_links_by_fingerprints_too(spark):
    """The first three differ in few fingerprint bits, though their sets of shingles are unlike."""
    texts = ["a " * 60 + end for end in ("x", "y", "z")] + ["one two three four five six seven", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert max(_jaccard(texts[0], other) for other in texts[1:3]) < 0.8
    kept = corpus_pipeline.drop_near_copies(spark, frame, "").collect()
    assert sorted(row["doc_id"] for row in kept) == [0, 3, 4, 5]
    assert simhash.keep_one(frame).count() == 6
