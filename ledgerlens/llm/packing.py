"""Packing by lexical retrieval: windows are filled with unused neighbours of their seed.

A shard is a run of documents of one input split, closed at a bounded number of ids. Over a
shard an inverted index with BM25 weights is built; the next unused document seeds a window,
all its terms ask the index, and the best unused neighbours fill the window, the last of
them cut where the window ends. Its rest goes on as the next seed. What is left at the end of a
shard is cut into powers of two, which need no padding. Nothing is shuffled, and the work per
shard is bounded, so the cost follows the number of shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import as_bytes, ship_package
from ledgerlens.llm.words import encoder, slices

#: Longest sequence.
WINDOW = 2048

#: A shard is closed at this many ids (a longer document has a shard of its own).
SHARD_IDS = 2_000_000

_K1, _B = 1.2, 0.75

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

#: Sequences a task may number; the task's number makes them unique.
_PER_TASK = 1 << 33


class Index:
    """BM25 weights of the terms (token ids) of a shard's documents, by term."""

    def __init__(self, docs: list[np.ndarray]):
        found = [np.unique(ids, return_counts=True) for ids in docs]
        self.size = len(docs)
        terms = np.concatenate([terms for terms, _ in found])
        counts = np.concatenate([counts for _, counts in found]).astype(np.float64)
        owner = np.repeat(np.arange(self.size), [len(terms) for terms, _ in found])
        lengths = np.asarray([len(ids) for ids in docs], dtype=np.float64)
        self.starts = np.concatenate([[0], np.cumsum([len(terms) for terms, _ in found])])
        frequency = np.bincount(terms)
        idf = np.log1p((self.size - frequency + 0.5) / (frequency + 0.5))
        saturated = counts * (_K1 + 1) / (
            counts + _K1 * (1 - _B + _B * lengths[owner] / lengths.mean())
        )
        self.terms, self.weights = terms, idf[terms] * saturated
        order = np.argsort(terms, kind="stable")
        self.posted, self.posted_weights = owner[order], self.weights[order]
        self.lists = np.concatenate([[0], np.cumsum(frequency)])

    def neighbours(self, seed: int, unused: np.ndarray, most: int) -> np.ndarray:
        """The best ``most`` unused documents that share a term with the seed, best first.

        All terms of the seed ask. Of equal scores the earlier document comes first.
        """
        terms = self.terms[self.starts[seed] : self.starts[seed + 1]]
        begins, ends = self.lists[terms], self.lists[terms + 1]
        sizes = ends - begins
        listed = np.repeat(ends - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.posted[listed], self.posted_weights[listed], self.size)
        hits = np.flatnonzero((scores > 0) & unused)
        found = scores[hits]
        if len(hits) > most:
            good = found >= np.partition(found, len(found) - most)[len(found) - most]
            hits, found = hits[good], found[good]
        return hits[np.argsort(-found, kind="stable")][:most]


def _windows(docs: list[np.ndarray], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); the last ones are powers of two."""
    index, size = Index(docs), len(docs)
    used = np.zeros(size, dtype=bool)
    following, carried = 0, None
    open_pieces: list[tuple[int, int, int]] = []
    while True:
        if carried is None:
            while following < size and used[following]:
                following += 1
            if following == size:
                break
            used[following] = True
            carried = (following, 0)
        seed, start = carried
        carried, room = None, window
        pieces: list[tuple[int, int, int]] = []

        def place(doc: int, start: int) -> tuple[int, int] | None:
            nonlocal room
            taken = min(room, len(docs[doc]) - start)
            pieces.append((doc, start, taken))
            room -= taken
            return (doc, start + taken) if start + taken < len(docs[doc]) else None

        carried = place(seed, start)
        if room:
            # Every document has an id at least, so no more than the room are of use.
            for doc in index.neighbours(seed, ~used, room):
                used[doc] = True
                carried = place(int(doc), 0)
                if not room:
                    break
        while room:
            while following < size and used[following]:
                following += 1
            if following == size:
                break
            used[following] = True
            carried = place(following, 0)
        if room:
            open_pieces = pieces
            break
        yield pieces
    left = sum(length for _, _, length in open_pieces)
    rest = iter(open_pieces)
    doc, start, length = next(rest, (0, 0, 0))
    for power in reversed(range(window.bit_length())):
        if not left >> power & 1:
            continue
        room, pieces = 1 << power, []
        while room:
            if not length:
                doc, start, length = next(rest)
            taken = min(room, length)
            pieces.append((doc, start, taken))
            start, length, room = start + taken, length - taken, room - taken
        yield pieces


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Every document is its ids and ``end_id``; each id lies in one piece, ``ids`` holds those of
    the piece as little-endian unsigned 32-bit integers. Sequences have ``window`` ids or a
    smaller power of two, so no padding is needed. A null text is empty and has the end id only;
    null keys and repeated rows are packed like others; other columns are not read; an empty
    table has no pieces.
    """
    ship_package(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer_path)
        sequence = TaskContext.get().partitionId() * _PER_TASK
        end = np.asarray([end_id], dtype=np.uint32)
        keys: list[int | None] = []
        shard: list[np.ndarray] = []
        size = 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()
            ]
            names = [field.split()[0] for field in _PIECES.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)], names=names
            )

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            found: list[tuple] = []
            for pieces in _windows(shard, window):
                offset = 0
                for doc, start, length in pieces:
                    ids = shard[doc][start : start + length].astype("<u4").tobytes()
                    found.append(
                        (keys[doc], start, length, ids, len(shard[doc]), sequence, offset)
                    )
                    offset += length
                sequence += 1
                if len(found) >= 2000:
                    yield rows(found)
                    found = []
            if found:
                yield rows(found)

        for whole in batches:
            for batch in slices(whole, column="_text"):
                for doc, raw in zip(
                    batch.column("_key").to_pylist(), library.encode(batch.column("_text"))
                ):
                    ids = np.concatenate([np.frombuffer(raw, "<u4"), end])
                    if shard and size + len(ids) > shard_ids:
                        yield from flush()
                        keys, shard, size = [], [], 0
                    keys.append(doc)
                    shard.append(ids)
                    size += len(ids)
        if shard:
            yield from flush()

    plain = docs.select(F.col(key).cast("long").alias("_key"), as_bytes(text).alias("_text"))
    return plain.mapInArrow(pack, _PIECES)
