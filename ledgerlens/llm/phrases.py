"""Collocations: phrases of two to four words that hold together, by the SON partitioning method.

A phrase with ``support`` occurrences in all has, in at least one of several shards, at least the
part of ``support`` that is the shard's part of the language's text. So:

1. every shard (texts of one checksum remainder) is mined completely at its proportionally lowered
   support: words, then pairs, then longer phrases whose two shorter parts are candidates already;
2. what is frequent in some shard is a candidate; candidates of all shards are united;
3. all candidates, and nothing else, are counted over all documents, exactly.

Languages are counted apart. In steps 1 and 2 phrases are hashes: a task sends sorted lists of
them, cut into ranges so that the counts of a shard are added up in many tasks. In step 3 they are
counted as texts, so two phrases with one hash only make a candidate too many. Candidates reach the
tasks as a filter of fixed size (``FILTER_BITS``): a full filter lets more phrases through to the
count, and never loses one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.staging import Stage, as_bytes, ship_package
from ledgerlens.llm.words import slices

#: Phrases have two to this many words.
LONGEST = 4

#: Fewest occurrences of a phrase in its language.
SUPPORT = 30

#: Parts of the texts that are mined by themselves. With s shards of one size the support within
#: one is SUPPORT / s, so more shards let more candidates through.
SHARDS = 8

#: Text bytes of a shard and language whose counts are added up in one task.
RANGE_BYTES = 16 << 20

#: Size of the candidate filter (2**27 bits are 16 MB).
FILTER_BITS = 27

#: Text bytes that a task counts at once, about; longer texts are cut between two pieces.
TOGETHER = 2 << 20

#: Words of more bytes than this are hashed one by one.
LONG_WORD = 40

#: Language of documents without one.
NO_LANGUAGE = "und"

#: Candidate phrases are ranked in this many parts of a language before the parts are put together.
RANKING_PARTS = 64

# What a byte is: part of a word, between words, or between pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(sign) for sign in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2

_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTES = [np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64) for seed in (11, 12)]


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


def _seed(name: bytes, table: int) -> int:
    return int.from_bytes(hashlib.sha256(bytes([table]) + name).digest()[:8], "little")


class _Words:
    """The words of many texts: where they stand, their pieces and groups, and hashes of phrases.

    ``rows`` are (language, shard, text); words of one language and shard stand together.
    """

    def __init__(self, rows: list[tuple[bytes, int, bytes]]):
        rows.sort(key=lambda row: row[:2])
        # A line feed ends a piece, so no phrase lies across two texts.
        self.raw = b"\n".join([*[text for _, _, text in rows], b""]).lower()
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        kind = _KIND[self.data]
        inside = np.zeros(len(kind) + 1, dtype=np.int8)
        inside[1:] = kind == 0
        edges = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        sizes = np.array([len(text) + 1 for _, _, text in rows], dtype=np.int64)
        first_word = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        #: (language, shard, first word, word after the last) of every group that has words
        self.groups: list[tuple[bytes, int, int, int]] = []
        for (name, shard, _), start, end in zip(rows, first_word[:-1].tolist(), first_word[1:].tolist(), strict=True):
            if self.groups and self.groups[-1][:2] == (name, shard):
                self.groups[-1] = (name, shard, self.groups[-1][2], end)
            else:
                self.groups.append((name, shard, start, end))

    def first_hashes(self, table: int) -> np.ndarray:
        """A hash of every word and its language."""
        seeds = np.zeros(len(self.starts), dtype=np.uint64)
        for name, _, start, end in self.groups:
            seeds[start:end] = _seed(name, table)
        lengths = self.ends - self.starts
        # Byte by byte for all words that have so many, the longest words first.
        order = np.argsort(np.minimum(lengths, LONG_WORD + 1).astype(np.uint8), kind="stable")[::-1]
        starts, sorted_lengths, found = self.starts[order], lengths[order], seeds[order]
        for at in range(min(LONG_WORD, int(lengths.max(initial=0)))):
            some = np.searchsorted(-sorted_lengths, -at)
            found[:some] *= _FACTOR
            found[:some] += _BYTES[table][self.data[starts[:some] + at]]
        for at in np.flatnonzero(sorted_lengths > LONG_WORD):
            word = self.raw[starts[at] : starts[at] + sorted_lengths[at]]
            found[at] += np.uint64(_seed(word, table))
        hashes = np.empty_like(found)
        hashes[order] = _mixed(found)
        return hashes

    def longer(self, shorter: np.ndarray, words: np.ndarray) -> np.ndarray:
        """From hashes of phrases of n words those of n + 1, of all places (also across pieces)."""
        size = len(words) - len(shorter) + 1
        keep = max(0, len(words) - size)
        return _mixed(shorter[:keep] * _FACTOR + (words[size:] ^ (words[size:] >> np.uint64(9))) + np.uint64(size))

    def whole(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from a place are of one piece."""
        if len(self.piece) < size:
            return np.zeros(0, dtype=bool)
        return self.piece[size - 1 :] == self.piece[: len(self.piece) - size + 1]

    def text(self, at: int, size: int) -> bytes:
        """The words from a place joined by one space."""
        return b" ".join(self.raw[self.starts[at] : self.ends[at + size - 1]].split())


def _kept(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The hashes with only their first bits, which the counts of a shard keep."""
    drop = np.uint64(64 - bits)
    return (hashes >> drop) << drop


def _places(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of every hash in a candidate filter of 2**width bits."""
    shift = np.uint64(64 - width)
    return hashes >> shift, _mixed(hashes.copy()) >> shift


def _passes(candidates: tuple[np.ndarray, int], hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes may be candidates."""
    marks, bits = candidates
    held = np.ones(len(hashes), dtype=bool)
    for place in _places(_kept(hashes, bits), (64 * len(marks)).bit_length() - 1):
        held &= (marks[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return held


def _marks(candidates: np.ndarray, width: int) -> pa.Table:
    """64-bit words (their place and the bits set in them) of the filter of these hashes."""
    places = np.unique(np.concatenate(_places(candidates, width)))
    words, first = np.unique(places >> np.uint64(6), return_index=True)
    bits = np.uint64(1) << (places & np.uint64(63))
    masks = np.bitwise_or.reduceat(bits, first) if len(first) else bits
    return pa.table({"at": pa.array(words.astype(np.int32)), "mask": pa.array(masks.view(np.int64))})


def _enter(marked: DataFrame, marks: np.ndarray) -> None:
    """Enter candidates into the filter; what is gathered is as large as the filter at most."""
    gathered = marked.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    marks[gathered.column("at").to_numpy()] |= gathered.column("mask").to_numpy().view(np.uint64)


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about TOGETHER bytes, cut where a piece ends."""
    start = 0
    while len(text) - start > TOGETHER:
        cut = _BREAK.search(text, start + TOGETHER)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def _batches(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[_Words]:
    """The texts of a task, several at once."""
    rows, size = [], 0
    for whole in batches:
        for batch in slices(whole, TOGETHER, "_text"):
            for name, raw in zip(batch.column("_lang"), batch.column("_text"), strict=True):
                text = raw.as_py()
                shard = zlib.crc32(text) % shards
                for part in _parts(text):
                    if rows and size + len(part) > TOGETHER:
                        yield _Words(rows)
                        rows, size = [], 0
                    rows.append((name.as_py(), shard, part))
                    size += len(part) + 1
    if rows:
        yield _Words(rows)


def _shares(plain: DataFrame, support: int, shards: int) -> DataFrame:
    """Text bytes and lowered support (``least``) of every language and shard."""
    shard = (F.crc32("_text") % shards).cast("int").alias("shard")
    sizes = plain.groupBy(F.col("_lang").cast("string").alias("lang"), shard).agg(
        F.sum(F.octet_length("_text") + 1).alias("bytes")
    )
    stored = Stage(sizes, "phrase-shards").frame
    whole = stored.groupBy("lang").agg(F.sum("bytes").alias("all_bytes"))
    least = F.expr(f"(cast({support} as decimal(20,0)) * bytes + all_bytes - 1) div all_bytes")
    return stored.join(whole, "lang").select("lang", "shard", "bytes", least.alias("least"))


_LISTS = "lang string, shard int, part int, hashes binary, counts binary"


def _mine(
    plain: DataFrame, size: int, shares: DataFrame, shards: int, known: Broadcast, bits: int, width: int
) -> DataFrame:
    """Filter words of all phrases of ``size`` words that are frequent in a shard.

    ``known`` is the filter of all shorter candidates, ``bits`` how much of a hash is counted.
    """
    dropped = np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _batches(batches, shards):
            words = hashes = texts.first_hashes(0)
            held = np.ones(len(words), dtype=bool)
            for shorter in range(1, size):
                fits = held & texts.whole(shorter)
                some = np.flatnonzero(fits)
                fits[some] = _passes(known.value, hashes[some])
                held = fits[:-1] & fits[1:]  # both parts that are one word shorter
                hashes = texts.longer(hashes, words)
            held &= texts.whole(size)
            rows = []
            for name, shard, start, end in texts.groups:
                some = np.sort(hashes[start:end][held[start:end]] >> dropped)
                if not len(some):
                    continue
                first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
                counts = np.diff(np.append(first, len(some))).astype("<u4")
                some = some[first]
                parts, edges = np.unique(some >> np.uint64(32), return_index=True)
                low, edges = some.astype("<u4"), [*edges.tolist(), len(some)]
                for part, left, right in zip(parts.tolist(), edges[:-1], edges[1:], strict=True):
                    rows.append((name.decode(), shard, part, low[left:right].tobytes(), counts[left:right].tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(some), kind) for some, kind in zip(columns, kinds, strict=True)],
                names=["lang", "shard", "part", "hashes", "counts"],
            )

    def add_up(table: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype="<u4")
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype="<u4")
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        frequent = hashes[first[total >= table.column("least")[0].as_py()]].astype(np.uint64)
        frequent += np.uint64(table.column("part")[0].as_py()) << np.uint64(32)
        return _marks(frequent << dropped, width)

    lists = plain.mapInArrow(count, _LISTS).join(shares.select("lang", "shard", "least"), ["lang", "shard"])
    return lists.groupBy("lang", "shard", "part").applyInArrow(add_up, "at int, mask bigint")


def _count(plain: DataFrame, longest: int, known: Broadcast) -> DataFrame:
    """lang, size, phrase and f of all candidates, counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _batches(batches, 1):
            rows = [(name.decode(), 0, "", end - start) for name, _, start, end in texts.groups]
            group_ends = np.array([end for *_, end in texts.groups])
            words, others = texts.first_hashes(0), texts.first_hashes(1)
            hashes, checks = words, others
            for size in range(1, longest + 1):
                places = np.flatnonzero(texts.whole(size))
                places = places[_passes(known.value, hashes[places])]
                places = places[np.lexsort((checks[places], hashes[places]))]
                new = np.ones(len(places), dtype=bool)
                new[1:] = (hashes[places[1:]] != hashes[places[:-1]]) | (checks[places[1:]] != checks[places[:-1]])
                first = np.flatnonzero(new)
                counts = np.diff(np.append(first, len(places)))
                group = np.searchsorted(group_ends, places[first], side="right")
                for at, n, of in zip(places[first].tolist(), counts.tolist(), group.tolist(), strict=True):
                    name = texts.groups[of][0].decode()
                    rows.append((name, size, texts.text(at, size).decode("utf-8", "replace"), n))
                hashes, checks = texts.longer(hashes, words), texts.longer(checks, others)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(some), kind) for some, kind in zip(columns, kinds, strict=True)],
                names=["lang", "size", "phrase", "n"],
            )

    counted = plain.mapInArrow(count, "lang string, size int, phrase string, n bigint")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    filter_bits: int = FILTER_BITS,
    range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to ``longest`` words with at least ``support``
    occurrences, and (lang, n) with the number of words of every language."""
    spark = docs.sparkSession
    ship_package(spark)
    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).cast("binary")
    plain = docs.select(as_bytes(text).alias("_text"), language.alias("_lang"))
    shares = _shares(plain, support, shards)
    largest = shares.agg(F.max("bytes")).first()[0] or 0
    # 32 bits of a hash in its range, and as many more as there are ranges.
    bits = 32 + min(30, (largest // range_bytes).bit_length())
    marks = np.zeros(1 << (filter_bits - 6), dtype=np.uint64)
    known = spark.sparkContext.broadcast((marks, bits))
    for size in range(1, longest + 1):
        _enter(_mine(plain, size, shares, shards, known, bits, filter_bits), marks)
        known.unpersist()
        known = spark.sparkContext.broadcast((marks, bits))
    counted = Stage(_count(plain, longest, known).where(f"f >= {support} OR size = 0"), "phrases").frame
    words = counted.where("size = 0").select("lang", F.col("f").alias("n"))
    return counted.where("size > 0"), words


def _salt(of: str) -> Column:
    return F.pmod(F.hash(of), F.lit(16))


def scored_phrases(frequent: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of every frequent phrase of two words or more.

    A cut after k words has the score floor(2000000 a / (l + r)); the lowest counts, the smallest k of
    equal ones. Phrases that hold together with more words at least eight times in ten are left out.
    """
    longest = LONGEST if frequent.isEmpty() else frequent.agg(F.max("size")).first()[0]
    several = frequent.where("size > 1").withColumnRenamed("f", "a")
    cuts = several.withColumn("k", F.explode(F.expr("CASE WHEN size > 1 THEN sequence(1, size - 1) END")))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
        _salt("phrase").alias("salt"),
    )
    # One word can be part of a large share of all phrases: its rows are dealt to 16 salts.
    parts = frequent.where(F.col("size") < longest).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(15)))
    )
    for part, name in (("first", "l"), ("rest", "r")):
        side = parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name), "salt")
        # Spark sizes these rows by their compressed file, as if each stood once, and would broadcast them.
        cuts = cuts.join(side.hint("merge"), ["lang", part, "salt"])
    exact = "decimal(20,0)"
    score = f"cast(cast(2000000 as {exact}) * cast(a as {exact}) div (cast(l as {exact}) + cast(r as {exact})) as bigint)"
    best = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("best")
    )
    # The most frequent longer phrase around each phrase.
    longer = several.where("size > 2").withColumn(
        "inner",
        F.expr(
            "CASE WHEN size > 2 THEN flatten(transform(sequence(2, size - 1),"
            " m -> transform(sequence(1, size - m + 1),"
            " s -> array_join(slice(split(phrase, ' '), s, m), ' ')))) END"
        ),
    )
    around = (
        longer.select("lang", F.explode("inner").alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = best.join(around, ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR cast(100 as {exact}) * longer < cast(80 as {exact}) * a")
    )
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    shards: int = SHARDS,
) -> DataFrame:
    """The ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    a is the number of occurrences, l and r those of the two parts of its weakest cut, n the words
    of the language. A null text is empty, documents without a language are one of their own;
    repeated rows count again, ids and other columns are not read. An empty table, or one without
    frequent phrases, gives no rows.
    """
    frequent, words = frequent_phrases(docs, text, lang, support, LONGEST, shards)
    scored = scored_phrases(frequent)
    order = "score DESC, a DESC, phrase"
    part = f"pmod(hash(phrase), {RANKING_PARTS})"
    first = scored.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, {part} ORDER BY {order})"))
    ranked = first.where(F.col("rank") <= top).withColumn(
        "rank", F.expr(f"row_number() OVER (PARTITION BY lang ORDER BY {order})").cast("long")
    )
    return (
        ranked.where(F.col("rank") <= top)
        .join(words, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
