"""Repeated byte strings across a corpus, by distributed prefix doubling over sampled positions.

A position is repeated when the ``length`` bytes from it also start somewhere else. Doubling over
every byte would sort the whole corpus once per round, so positions are first gathered under
sample positions that their own content chooses: of the ``length`` bytes from p, the leftmost
smallest hash among their strings of half that length. Equal strings choose equal samples at equal
distances, so p can only be equal to positions gathered under an equal sample.

Round 0 ranks the samples by their half-length string, the first half of the doubling; what is
unique drops out. A sample stands for an interval of positions. Each later round divides the
intervals that are still open and ranks the pieces by growing strings: by the bytes that all positions
of a piece share (the core) and by all bytes they reach over (the union). A core that is
unique ends the piece, since none of its positions is repeated; an equal union elsewhere settles it,
since all of them are. What is neither goes on. In the last round a piece is one position, core and
union are its ``length`` bytes, and nothing stays open.

Ranks are pairs of 64-bit hashes (of the half-length string and of core or union), so unequal
strings count as equal with a probability of 2**-128 for a pair. Counting is done by partial
sums and looked up by joins that split hot keys, so a passage in very many documents is never
gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.grams import GramHashes, leftmost_minima
from ledgerlens.llm.staging import Stage, as_bytes, row_number, ship_package

#: Bytes hashed at a time; longer texts are taken in overlapping parts.
PART_BYTES = 1 << 20

#: Open intervals are sent to every executor only up to this size, else joined by shuffling.
BROADCAST_BYTES = 64 << 20

#: A round divides intervals into pieces shorter by this factor.
_FINER = 5

_INTERVAL = "row bigint, anchor int, low int, high int, need boolean, "
_RANKED = "half bigint, piece int, core bigint, whole bigint, " + _INTERVAL.rstrip(", ")


def _parts(batch: pa.RecordBatch, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) of texts or parts of them, about PART_BYTES at a time."""
    found: list[tuple[int, int, bytes]] = []
    size = 0
    for row, raw in zip(batch.column("row").to_pylist(), batch.column("_text")):
        data = raw.as_py()
        for start in range(0, max(1, len(data) - length + 1), PART_BYTES):
            piece = data[start : start + PART_BYTES + length - 1]
            if len(piece) < length:
                continue
            if found and size + len(piece) > PART_BYTES:
                yield found
                found, size = [], 0
            found.append((row, start, piece))
            size += len(piece)
    if found:
        yield found


def _samples(parts: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """half-length hash, row, anchor, low, high of every sample, and the bytes it reaches over."""
    half = length // 2
    sizes = np.asarray([len(data) for _, _, data in parts])
    ends = np.cumsum(sizes)
    raw = b"".join(data for _, _, data in parts)
    hashes = GramHashes(np.frombuffer(raw, np.uint8)).all(half)
    chosen = leftmost_minima(hashes, length - half + 1)
    owner = np.repeat(np.arange(len(parts)), sizes)[: len(chosen)]
    place = np.flatnonzero(np.arange(len(chosen)) + length <= ends[owner])
    chosen, owner = chosen[place], owner[place]
    fresh = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    low, high, anchor, of = place[first], place[last], chosen[first].astype(np.int64), owner[first]
    shift = np.asarray([offset for _, offset, _ in parts])[of] - (ends - sizes)[of]
    rows = np.asarray([row for row, _, _ in parts], dtype=np.int64)[of]
    whole = np.fromiter(
        (xxhash.xxh64_intdigest(raw[a : b + length]) for a, b in zip(low.tolist(), high.tolist())),
        np.uint64,
        len(low),
    )
    return hashes[anchor].view(np.int64), rows, anchor + shift, low + shift, high + shift, whole.view(np.int64)


def _halves(texts: DataFrame, length: int) -> DataFrame:
    """The half-length rank of every sample position."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in _parts(batch, length):
                yield pa.RecordBatch.from_arrays([pa.array(_samples(parts, length)[0])], ["half"])

    return texts.mapInArrow(sample, "half bigint")


def _sampled(texts: DataFrame, length: int) -> DataFrame:
    """Every sample position with its interval and the rank of all it reaches over."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in _parts(batch, length):
                half, row, anchor, low, high, whole = _samples(parts, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(half), pa.array(whole), pa.array(row),
                        *[pa.array(x.astype(np.int32)) for x in (anchor, low, high)],
                    ],
                    names=["half", "whole", "row", "anchor", "low", "high"],
                )

    return texts.mapInArrow(
        sample, "half bigint, whole bigint, row bigint, anchor int, low int, high int"
    )


def _beside(texts: DataFrame, listed: Stage) -> DataFrame:
    """The texts with open intervals, and these: sent to all while small, else shuffled."""
    size = listed.frame.agg(
        F.sum(F.size("spans") * 24 + 32).cast("long").alias("bytes")
    ).first()["bytes"]
    small = (size or 0) <= BROADCAST_BYTES
    return texts.join(F.broadcast(listed.frame) if small else listed.frame, "row")


def _ranked(texts: DataFrame, open_intervals: DataFrame, length: int, width: int) -> Stage:
    """Open intervals cut into pieces of ``width`` positions, with the ranks of core and union."""
    half = length // 2
    listed = Stage(
        open_intervals.groupBy("row").agg(
            F.collect_list(F.struct("half", "anchor", "low", "high", "need")).alias("spans")
        ),
        "open-intervals",
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh64_intdigest
        for batch in batches:
            for row, text, spans in zip(
                batch.column("row").to_pylist(), batch.column("_text"), batch.column("spans")
            ):
                data, found = text.as_py(), []
                for span in spans.as_py():
                    anchor = span["anchor"]
                    near, far = anchor - span["high"], anchor - span["low"]
                    for piece in range(near // width, far // width + 1):
                        # Distances from position to sample that belong to this piece.
                        least, most = piece * width, min(piece * width + width - 1, length - half)
                        low, high = anchor - min(most, far), anchor - max(least, near)
                        core = hashed(data[anchor - least : anchor - most + length])
                        whole = hashed(data[low : high + length], ((anchor - low) << 20) | (anchor - high))
                        found.append(
                            (span["half"], piece, core, whole, row, anchor, low, high, span["need"])
                        )
                half_, piece, core, whole, rows, anchor, low, high, need = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(half_, pa.int64()),
                        pa.array(piece, pa.int32()),
                        pa.array(np.asarray(core, dtype=np.uint64).view(np.int64)),
                        pa.array(np.asarray(whole, dtype=np.uint64).view(np.int64)),
                        pa.array(rows, pa.int64()),
                        *[pa.array(x, pa.int32()) for x in (anchor, low, high)],
                        pa.array(need),
                    ],
                    names=[field.split()[0] for field in _RANKED.split(", ")],
                )

    ranked = Stage(_beside(texts, listed).mapInArrow(rank, _RANKED), "ranked")
    listed.drop()
    return ranked


def _settle(ranked: DataFrame) -> tuple[Stage, DataFrame]:
    """Settled intervals (row, low, high) of one round, and what stays open for the next."""
    group = ["half", "piece", "core"]
    classes = Stage(
        ranked.groupBy(*group, "whole").agg(
            F.count(F.lit(1)).alias("members"),
            F.max("need").alias("need"),
            F.min(F.struct("row", "anchor", "low", "high")).alias("one"),
        ),
        "rank-classes",
    ).frame
    several = classes.where("members > 1 and need").select(*group, "whole")
    settled = Stage(
        ranked.where("need")
        .join(several, [*group, "whole"], "left_semi")
        .select("row", "low", "high"),
        "settled",
    )
    alone = F.col("need") & (F.col("members") == 1)
    mixed = (
        classes.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("kinds"), F.max(alone).alias("open"))
        .where("kinds > 1 and open")
        .select(*group)
    )
    # One position stands for all with the same union: the others are settled.
    still_open = classes.join(mixed, group, "left_semi").select(
        "half", "one.row", "one.anchor", "one.low", "one.high", alone.alias("need")
    )
    return settled, still_open


def repeated_strings(
    docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, removed (array of start, end), kept (binary).

    ``removed`` are the maximal runs of bytes covered by a string of ``length`` bytes that also
    starts anywhere else, in the same text or another, judged on the whole input; ``kept`` are
    the other bytes. A null text is empty; texts shorter than ``length`` stay whole. Of repeated
    rows all lose what they share. An empty table gives an empty result; other columns are not
    read. ``length`` is at least 16.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.col(key).alias("_key"), row_number().alias("row"), as_bytes(text).alias("_text")
    )
    plain = texts.select("row", "_text")
    # Only the rank travels in the first count, and only repeated ranks come back.
    repeated = Stage(
        _halves(plain, length).groupBy("half").count().where("count > 1").select("half"),
        "repeated-halves",
    )
    ranked = Stage(
        _sampled(plain, length)
        .join(repeated.frame, "half", "left_semi")
        .withColumns({"piece": F.lit(0), "core": F.lit(0).cast("long"), "need": F.lit(True)}),
        "ranked",
    )
    repeated.drop()
    found: list[Stage] = []
    width = length - length // 2 + 1
    while True:
        settled, still_open = _settle(ranked.frame)
        found.append(settled)
        if width == 1:
            break
        width = max(1, width // _FINER)
        following = _ranked(plain, still_open, length, width)
        ranked.drop()
        ranked = following
    intervals = found[0].frame
    for more in found[1:]:
        intervals = intervals.unionByName(more.frame)
    listed = Stage(
        intervals.groupBy("row").agg(
            F.array_sort(
                F.collect_list(
                    F.struct(F.col("low").alias("start"), (F.col("high") + length).alias("end"))
                )
            ).alias("spans")
        ),
        "repeated-spans",
    )
    for done in (*found, ranked):
        done.drop()

    kind = texts.schema["_key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for raw, spans in zip(batch.column("_text"), batch.column("spans")):
                data = raw.as_py()
                runs: list[list[int]] = []
                for span in spans.as_py() or []:
                    if runs and span["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span["end"])
                    else:
                        runs.append([span["start"], span["end"]])
                edges = [0, *(edge for run in runs for edge in run), len(data)]
                sizes.append(len(data))
                removed.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.list_(span)),
                    pa.array(kept, pa.binary()),
                ],
                names=[key, "n_bytes", "removed", "kept"],
            )

    # Spans grow with the texts, so both sides meet by shuffle at every size.
    return texts.join(listed.frame, "row", "left").select("_key", "_text", "spans").mapInArrow(
        cut, f"`{key}` {kind}, n_bytes bigint, removed array<struct<start:int,end:int>>, kept binary"
    )
