from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import LONG, ROWS, SF_TINY, awkward, empty, table
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, held, packing, queries, token_files, words
from ledgerlens.llm.elias_fano import EliasFano
from ledgerlens.session import shared_folder

FILE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(FILE)
    found.encode_special_tokens = True
    return found


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " ", "  a  b ", "x\n\ny z", "a b c", "'s 't don't we'll", "a \n b", "é à ñ ß …",
    "日本 語 a", "tab\tb c", "end ", " start", "a\x1cb c\x85d", "<|endoftext|> x", "a  ", "ǆ ɏ Ω x",
    "x" * 3000, "1 2  3\r\n4", "​ zero 　 wide",
]


def test_remembered_words_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(words, "REMEMBERED", 50)
    encoder = words.Encoder(FILE)
    texts = ODD + [text or "" for _, text, *_ in ROWS]
    for start in range(0, len(texts), 3):
        some = texts[start : start + 3]
        got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(some)]
        assert got == [_ids(library, text) for text in some]


def test_cut_texts_equal_the_library(library):
    signs = np.array(list("aatSé9²ªß×'.,!?(_&-") + [" "] * 8 + ["\n", "\n", "\n\n", "\t", "'s", "the", " The", "\r\n"])
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(signs, size)) for size in rng.integers(0, 60, 6000)]
    encoder = words.Encoder(FILE)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(texts)]
    assert got == [found.ids for found in library.encode_batch_fast(texts, add_special_tokens=False)]
    spelled = pa.array([text.encode() for text in texts] + [b"bad \xff byte"])
    again = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(spelled)]
    assert again == [*got, _ids(library, "bad \ufffd byte")]


@pytest.mark.parametrize("size", [0, 1, 2, 63, 64, 65, 1000])
def test_elias_fano(size):
    rng = np.random.default_rng(size)
    numbers = np.cumsum(rng.integers(0, 5000, size))
    coded = EliasFano.encode(numbers)
    assert coded.decode().tolist() == numbers.tolist()
    assert [coded.select(i) for i in range(size)] == numbers.tolist()
    if size >= 1000:
        stored = len(coded.low) + len(coded.high) + len(coded.samples)
        assert stored < 8 * size / 3
    far = np.array([0, 0, 1 << 20, 1 << 20, 1 << 21])
    assert [EliasFano.encode(far).select(i) for i in range(5)] == far.tolist()


def test_token_files(spark, library):
    docs = [(row[0], row[1]) for row in table(SF_TINY, "documents")] + [
        (10_000 + at, text) for at, text in enumerate([*ODD, None, LONG])
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    path = shared_folder(spark, "test-token-files")
    token_files.write_token_files(frame, path, FILE, end_id=2, block_ids=5000)
    rows = {row["doc_id"]: row for row in token_files.read_token_files(spark, path).collect()}
    start = 0
    for doc, text in sorted(docs):
        ids = _ids(library, text) + [2]
        assert np.frombuffer(rows[doc]["ids"], "<u4").tolist() == ids
        assert rows[doc]["start"] == start
        start += len(ids)
    assert len(rows) == len(docs)


def test_token_files_awkward(spark):
    for frame, count in ((awkward(spark), 10), (empty(spark), 0)):
        path = shared_folder(spark, "test-token-files")
        token_files.write_token_files(frame, path, FILE, end_id=2)
        rows = token_files.read_token_files(spark, path).orderBy("start").collect()
        assert len(rows) == count
        at = 0
        for row in rows:
            assert row["start"] == at
            at += len(row["ids"]) // 4


@pytest.mark.parametrize("shard_ids", [packing.SHARD_IDS, 6000])
def test_packing_places_every_id_once(spark, library, shard_ids):
    docs = [(row[0], row[1]) for row in table(SF_TINY, "documents")] + [(9_999, None), (9_998, LONG)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    pieces = packing.pack_documents(frame, FILE, end_id=1, shard_ids=shard_ids).collect()
    want = {doc: _ids(library, text) + [1] for doc, text in docs}
    parts, sequences = {}, {}
    for piece in pieces:
        parts.setdefault(piece["doc_id"], []).append(piece)
        sequences.setdefault(piece["sequence_id"], []).append(piece)
        assert piece["doc_tokens"] == len(want[piece["doc_id"]])
    for doc, some in parts.items():
        some.sort(key=lambda piece: piece["start"])
        found = b"".join(bytes(piece["ids"]) for piece in some)
        assert np.frombuffer(found, "<u4").tolist() == want[doc]
        at = 0
        for piece in some:
            assert piece["start"] == at
            at += piece["length"]
    assert parts.keys() == want.keys()
    for some in sequences.values():
        some.sort(key=lambda piece: piece["offset"])
        at = 0
        for piece in some:
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= 2048 and at & (at - 1) == 0


def test_packing_prefers_neighbours():
    rng = np.random.default_rng(0)
    topics = [rng.integers(at * 100, at * 100 + 100, (20, 256)) for at in range(10)]
    docs = [ids.astype(np.uint32) for rows in zip(*topics) for ids in rows]
    together = [len({doc % 10 for doc, _, _ in pieces}) for pieces in packing._windows(docs, 2048)]
    assert sum(together) / len(together) < 2


def test_packing_awkward(spark):
    pieces = packing.pack_documents(awkward(spark), FILE, end_id=1).collect()
    assert sum(piece["start"] == 0 for piece in pieces) == 10
    assert packing.pack_documents(empty(spark), FILE, end_id=1).count() == 0


@pytest.fixture(scope="module")
def plain_codec():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_equals_the_library_and_decodes(spark, plain_codec, monkeypatch):
    texts = [*ODD, None, LONG, "no spaces " + "y" * 2000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    encoded = bpe.encode_texts(frame, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode_ids(encoded, RANKS, public_tokenizers.PATTERN).collect()
    for row in rows:
        text = texts[row["doc_id"]] or ""
        assert row["ids"] == plain_codec.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert len(rows) == len(texts)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_safe_parts(plain_codec, size):
    for text in [*ODD, "it's  a  test \n of   spaces 12 34's !? x" * 5, LONG[:5000]]:
        parts = bpe.safe_parts(text, size)
        assert "".join(parts) == text
        ids = [number for part in parts for number in plain_codec.encode_ordinary(part)]
        assert ids == plain_codec.encode_ordinary(text)


def test_bpe_awkward(spark):
    encoded = bpe.encode_texts(awkward(spark), RANKS, public_tokenizers.PATTERN)
    assert encoded.count() == 10
    assert bpe.encode_texts(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_query_digests(spark, library, plain_codec):
    docs = {row[0]: row[1] or "" for row in table(SF_TINY, "documents")}
    for row in queries.op10_byte_bpe(spark, SF_TINY).collect():
        ids = plain_codec.encode_ordinary(docs[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()
    for row in queries.op8_token_files(spark, SF_TINY).collect():
        ids = np.asarray(_ids(library, docs[row["doc_id"]]) + [2], "<u4")
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes()) and row["n_tokens"] == len(ids)
    pieces = queries.op4_packing(spark, SF_TINY)
    assert pieces.agg(F.sum("length")).first()[0] == sum(
        len(_ids(library, text)) + 1 for text in docs.values()
    )


def test_neighbours_follow_plain_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.3, size).clip(1, 400).astype(np.uint32) for size in rng.integers(1, 120, 60)]
    mean = np.mean([len(doc) for doc in docs])
    holders = {term: sum(term in doc for doc in docs) for term in range(1, 401)}

    def score(seed, other):
        total = 0.0
        for term in set(docs[seed].tolist()) & set(docs[other].tolist()):
            count, df = int((docs[other] == term).sum()), holders[term]
            idf = np.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            total += idf * count * 2.2 / (count + 1.2 * (0.25 + 0.75 * len(docs[other]) / mean))
        return total

    index = packing.Index(docs)
    for seed in range(0, 60, 7):
        unused = rng.random(60) < 0.7
        unused[seed] = False
        expected = [o for o in np.flatnonzero(unused) if score(seed, o) > 0]
        expected.sort(key=lambda o: (-round(score(seed, o), 9), o))
        assert index.neighbours(seed, unused, 60).tolist() == expected
        assert index.neighbours(seed, unused, 5).tolist() == expected[:5]


def test_a_worker_lets_go_of_words_before_other_work():
    """What packing remembers is not kept while the next operator cuts words or builds fingerprints."""
    held.held(("words", "some"), lambda: "an encoder")
    held.let_go()
    assert held._HELD == {}
