"""Runs of repeated words inside a text, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least two periods long, that no
neighbouring word extends. Periods up to ``DIRECT`` are read off by comparing the words with
themselves q places on. For the rest, at scales tau = 4, 8, 16, …:

* a place is highly periodic if the tau words from it have a period of at most tau / 3, which the
  shorter runs already found show;
* the synchronising set holds the places i where the smallest hash of tau words among the places
  i … i + tau, highly periodic ones left out, is that of i or of i + tau. Membership depends on the
  2 tau words from i only, so it repeats wherever these words do;
* two members with equal words, 3 tau - 1 to 6 tau - 2 places apart, propose that distance as a period.
  Equal members lie more than tau / 3 apart, so each has a bounded number of such partners;
* a run whose first period is itself highly periodic has no members there. It then lies across the
  border of two neighbouring highly periodic regions of one root, which propose their phase shift.

Every proposal is extended to both sides over hashes of 1, 2, 4, … words. The runs that are left are
compared word by word; should a hash have misled, the whole text is searched again with others.
Texts are independent of each other, so there is no shuffle and no group to split. Many texts are
searched at once as one sequence, with words between them that occur nowhere else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import as_bytes, ship_package
from ledgerlens.llm.words import slices

#: Words of a text: everything but the six white-space characters of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)

#: Shortest run, in words.
SHORTEST = 12

#: Periods found by direct comparison; the first scale tau = 4 takes over from 3 tau - 1.
DIRECT = 10

#: Text bytes searched as one sequence (a longer text is one by itself).
TOGETHER = 2 << 20

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


class _Names:
    """Hashes of all stretches of 1, 2, 4, … words of a sequence."""

    def __init__(self, codes: np.ndarray, salt: int):
        self.size = len(codes)
        self.factor = np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
        self.levels = [_mixed(codes.astype(np.uint64) * self.factor + np.uint64(salt + 1))]

    def level(self, k: int) -> np.ndarray:
        """Hashes of the 2**k words from every place that has so many."""
        while len(self.levels) <= k:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            keep = max(0, len(last) - half)
            self.levels.append(_mixed(last[:keep] * self.factor + (last[half:] ^ (last[half:] >> np.uint64(7)))))
        return self.levels[k]

    def at(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes that identify the ``length`` words from each place."""
        k = length.bit_length() - 1
        found = self.level(k)
        return found[starts], found[starts + length - (1 << k)]

    def forward(self, left: np.ndarray, right: np.ndarray, top: int) -> np.ndarray:
        """How many words agree from ``left`` and from ``right`` (the greater) on, below 2**(top + 1)."""
        done = np.zeros(len(left), dtype=np.int64)
        for k in range(top, -1, -1):
            self._step(left, right, done, k, 1)
        return done

    def backward(self, left: np.ndarray, right: np.ndarray, top: int) -> np.ndarray:
        """How many words agree before ``left`` and before ``right``."""
        done = np.zeros(len(left), dtype=np.int64)
        for k in range(top, -1, -1):
            self._step(left, right, done, k, -1)
        return done

    def _step(self, left: np.ndarray, right: np.ndarray, done: np.ndarray, k: int, way: int) -> None:
        names, size = self.level(k), 1 << k
        back = 0 if way > 0 else size
        a, b = left + way * done - back, right + way * done - back
        inside = np.flatnonzero((a >= 0) & (b < len(names)))
        done[inside[names[a[inside]] == names[b[inside]]]] += size


def _direct(codes: np.ndarray, period: int) -> np.ndarray:
    """Start and end of all stretches with this period, two periods long at least."""
    equal = np.zeros(max(0, len(codes) - period) + 2, dtype=np.int8)
    equal[1:-1] = codes[period:] == codes[:-period] if len(codes) > period else 0
    edges = np.flatnonzero(np.diff(equal))
    starts, ends = edges[::2], edges[1::2] + period
    keep = ends - starts >= 2 * period
    return np.stack([starts[keep], ends[keep]], axis=1)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of (start, end, period) rows with one stretch that with the smallest period, sorted."""
    if not len(runs):
        return runs.reshape(0, 3)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _highly_periodic(runs: np.ndarray, size: int, tau: int) -> np.ndarray:
    """The places from which tau words have a period of at most tau / 3."""
    some = runs[(runs[:, 2] <= tau // 3) & (runs[:, 1] - runs[:, 0] >= tau)]
    steps = np.zeros(size + 1, dtype=np.int32)
    np.add.at(steps, some[:, 0], 1)
    np.add.at(steps, some[:, 1] - tau + 1, -1)
    return np.cumsum(steps[:-1]) > 0


def synchronising_set(names: _Names, runs: np.ndarray, k: int) -> np.ndarray:
    """The members of the set at scale tau = 2**k; ``runs`` holds all runs of periods up to tau / 3."""
    tau, hashes = 1 << k, names.level(k)
    last = names.size - 2 * tau
    if last < 0:
        return np.zeros(0, dtype=np.int64)
    hashes = np.where(_highly_periodic(runs, names.size, tau)[: len(hashes)], _NONE, hashes)
    least = hashes
    for step in range(k):
        least = np.minimum(least[: len(least) - (1 << step)], least[1 << step :])
    least = np.minimum(least[: last + 1], hashes[tau : tau + last + 1])
    chosen = (hashes[: last + 1] == least) | (hashes[tau : tau + last + 1] == least)
    return np.flatnonzero(chosen & (least != _NONE))


def _equal_contexts(names: _Names, members: np.ndarray, text_of: np.ndarray, k: int):
    """Pairs (place, distance) of members with equal 2 tau words in one text, at this scale's distances."""
    tau = 1 << k
    contexts = names.level(k + 1)[members]
    # Sorted by text first: equal texts that are searched together propose nothing to each other.
    order = np.lexsort((members, contexts, text_of[members]))
    contexts, members = contexts[order], members[order]
    texts = text_of[members]
    found, step, some = [], 1, np.arange(len(members))
    while True:
        some = some[some + step < len(members)]
        distance = members[some + step] - members[some]
        near = (contexts[some + step] == contexts[some]) & (texts[some + step] == texts[some])
        some, distance = some[near & (distance <= 6 * tau - 2)], distance[near & (distance <= 6 * tau - 2)]
        if not len(some):
            break
        far = distance >= 3 * tau - 1
        found.append(np.stack([members[some[far]], distance[far]], axis=1))
        step += 1
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _shifted_regions(names: _Names, runs: np.ndarray, tau: int) -> np.ndarray:
    """Pairs (place, distance) proposed by neighbouring highly periodic regions with one root."""
    some = runs[(runs[:, 2] > 1) & (runs[:, 1] - runs[:, 0] >= 3 * tau - 1) & (runs[:, 2] <= tau // 3)]
    if len(some) < 2:
        return np.zeros((0, 2), dtype=np.int64)
    some = some[np.lexsort((some[:, 0], some[:, 2]))]
    beside = (some[1:, 2] == some[:-1, 2]) & (some[:-1, 1] >= some[1:, 0])
    found = []
    for at in np.flatnonzero(beside):
        (left, left_end, period), (right, right_end, _) = some[at].tolist(), some[at + 1].tolist()
        places = np.arange(left, left + period)
        heads, tails = names.at(places, period)
        head, tail = names.at(np.array([right]), period)
        same = np.flatnonzero((heads == head) & (tails == tail))
        if not len(same):
            continue
        shift = right - int(places[same[0]])  # and every multiple of the period more or less
        longest = min(left_end - left, right_end - right, 6 * tau - 2)
        first = shift % period
        first += max(0, -(-(3 * tau - 1 - first) // period)) * period
        distances = np.arange(first, longest + 1, period)
        starts = np.maximum(left, right - distances)
        found.append(np.stack([starts, distances], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _search(codes: np.ndarray, text_of: np.ndarray, longest: int, salt: int) -> np.ndarray:
    """(start, end, period) of all runs of at least ``3 * 4 - 1`` words, smallest periods, sorted."""
    names = _Names(codes, salt)
    found = []
    for period in range(1, min(DIRECT, longest // 2) + 1):
        stretches = _direct(codes, period)
        stretches = stretches[stretches[:, 1] - stretches[:, 0] >= DIRECT + 1]
        found.append(np.column_stack([stretches, np.full(len(stretches), period)]))
    runs = _smallest(np.concatenate(found)) if found else np.zeros((0, 3), dtype=np.int64)
    k, top = 2, longest.bit_length() - 1
    while 2 * (3 * (1 << k) - 1) <= longest:  # a run of this scale's shortest period fits
        tau = 1 << k
        members = synchronising_set(names, runs, k)
        proposed = np.concatenate(
            [_equal_contexts(names, members, text_of, k), _shifted_regions(names, runs, tau)]
        )
        if len(proposed):
            place, period = proposed[:, 0], proposed[:, 1]
            start = place - names.backward(place, place + period, top)
            end = place + period + names.forward(place, place + period, top)
            long = end - start >= 2 * period
            runs = _smallest(np.concatenate([runs, np.column_stack([start, end, period])[long]]))
        k += 1
    return runs


def _true_run(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    if not np.array_equal(codes[start : end - period], codes[start + period : end]):
        return False
    if start and codes[start - 1] == codes[start - 1 + period]:
        return False
    return end >= len(codes) or codes[end] != codes[end - period]


def runs_of(texts: list[list[str]], shortest: int = SHORTEST) -> list[np.ndarray]:
    """For every list of words its runs as rows (start, length, period), by start, then period."""
    known: dict[str, int] = {}
    codes: list[int] = []
    for number, words in enumerate(texts):
        codes.extend([known.setdefault(word, len(known)) for word in words])
        codes.append(-1 - number)  # a word that occurs nowhere else
    sequence = np.array(codes, dtype=np.int64)
    sizes = np.array([len(words) + 1 for words in texts], dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    salt = 0
    while True:
        runs = _search(sequence, text_of, int(sizes.max(initial=1)) - 1, salt)
        runs = runs[runs[:, 1] - runs[:, 0] >= shortest]
        if all(_true_run(sequence, *run) for run in runs.tolist()):
            break
        salt += 1
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = text_of[runs[:, 0]]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    answer = []
    for number in range(len(texts)):
        start, end, period = runs[cuts[number] : cuts[number + 1]].T
        answer.append(np.column_stack([start - edges[number], end - start, period]))
    return answer


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words without those that a run repeats after its first period."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[at] for at in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """key, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed`` of every row.

    ``collapsed`` are the words that no run repeats, joined by one space. A null or empty text
    has no words and no runs. Row by row: repeated rows and null keys are kept, other columns are
    not read, an empty table gives an empty result. A very long text is searched by itself; memory
    is about 8 bytes for every word and power of two below its number of words.
    """
    ship_package(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, TOGETHER, "_text"):
                texts = [
                    _WORD.findall(raw.as_py().decode("utf-8", "replace")) for raw in batch.column("_text")
                ]
                found = runs_of(texts, shortest)
                flat = np.concatenate(found).reshape(-1, 3)
                ends = np.concatenate([[0], np.cumsum([len(runs) for runs in found])])
                rows = pa.StructArray.from_arrays(
                    [pa.array(flat[:, at].astype(np.int64)) for at in range(3)],
                    names=["start", "length", "period"],
                )
                kept = [" ".join(collapsed(words, runs)) for words, runs in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows),
                        pa.array(kept, pa.string()),
                    ],
                    names=[key, "n_words", "runs", "collapsed"],
                )

    plain = docs.select(F.col(key), as_bytes(text).alias("_text"))
    kind = plain.schema[key].dataType.simpleString()
    return plain.mapInArrow(
        search,
        f"`{key}` {kind}, n_words bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )
