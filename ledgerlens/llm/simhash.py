"""Near duplicates by SimHash: fingerprints within a few bits, found with BK-trees.

Fingerprints that differ in at most r of 64 bits agree on one of r+1 blocks, and, the rest being
divided again, on one of r+1 parts of the rest. Every distinct fingerprint is therefore put
under (r+1)^2 keys, and only fingerprints that share a key can be near. A shard, the
fingerprints of a key, becomes a BK-tree: children are keyed by their distance to the parent, and a
search follows only edges within the radius. Shards meet in the tasks that search them: a tree over
all fingerprints would grow with the corpus and is never sent to the driver or to every executor.
A key with very many fingerprints is divided, and the trees of its parts are searched pairwise. What
leaves a shard is a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.held import let_go
from ledgerlens.llm.sorted_groups import groups
from ledgerlens.llm.staging import ROW, Stage, as_bytes, row_number, ship_package, without
from ledgerlens.operators.components import connected_components
from ledgerlens.session import discard_staged, shared_folder, staged_count

#: Fingerprints that one part of a divided shard holds.
SHARD = 8192

#: Sets of at most so many members are leaves of a tree and compared directly.
_LEAF = 48

_SEED = 42


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """The XXH64 hashes of all word shingles, repeats included; none for a text without words."""
    found = text.lower().split()  # ASCII letters and ASCII white space only, being bytes
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    ends = [end - 1 for end in accumulate(len(word) + 1 for word in found)]
    size = min(words, len(found))
    starts = [0, *(end + 1 for end in ends[: len(found) - size])]
    hashed = xxhash.xxh64_intdigest
    return np.fromiter(
        (hashed(joined[a:b], _SEED) for a, b in zip(starts, ends[size - 1 :])), np.uint64, len(starts)
    )


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    return int(_majority(_bit_totals(hashes[None, :]), len(hashes))[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3
) -> DataFrame:
    """_key, _row, fp (the 64 bits as a long) of every row; texts without words have fp 0."""
    ship_package(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = np.fromiter(
                (fingerprint(raw.as_py(), words) for raw in batch.column("_text")),
                np.uint64,
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_row"), pa.array(found.view(np.int64))],
                names=["_key", "_row", "fp"],
            )

    plain = docs.select(
        F.col(key).cast("long").alias("_key"), row_number().alias("_row"), as_bytes(text).alias("_text")
    )
    return plain.mapInArrow(build, "_key bigint, _row bigint, fp bigint")


def _bit_totals(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in every row, by carry-save addition of whole words."""
    totals, weight, level = np.zeros((len(hashes), 64), dtype=np.int64), 1, hashes
    while level.shape[1]:
        carried = []
        while level.shape[1] > 8:
            third = level.shape[1] // 3
            a, b, c = (level[:, at * third : (at + 1) * third] for at in range(3))
            half = a ^ b
            carried.append((a & b) | (c & half))
            level = np.concatenate([half ^ c, level[:, 3 * third :]], axis=1)
        raw = np.ascontiguousarray(level, dtype="<u8").view(np.uint8)
        bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(hashes), -1, 64)
        totals += weight * bits.sum(axis=1, dtype=np.int64)
        level = np.concatenate(carried, axis=1) if carried else level[:, :0]
        weight *= 2
    return totals


def _majority(totals: np.ndarray, count: int) -> np.ndarray:
    """One word per row: the bits set in over half of the hashes."""
    bits = (totals * 2 > count).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


#: Shingle hashes mixed at a time.
_MIXED = 1 << 14


def wide_fingerprint(hashes: np.ndarray, size: int) -> np.ndarray:
    """``size`` words of 64 majority bits, each word from another mixing of the shingle hashes."""
    if not len(hashes):
        return np.zeros(size, dtype=np.uint64)
    step = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    totals = np.zeros((size, 64), dtype=np.int64)
    for start in range(0, len(hashes), _MIXED):
        mixed = hashes[None, start : start + _MIXED] + step[:, None]
        mixed ^= mixed >> np.uint64(30)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(27)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        totals += _bit_totals(mixed)
    return _majority(totals, len(hashes))


class _Forest:
    """Components of a shard's members and the links that made them."""

    def __init__(self, size: int):
        self.component = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def link(self, one: int, others: np.ndarray) -> None:
        if not len(others):
            return
        own = self.component[one]
        labels, first = np.unique(self.component[others], return_index=True)
        fresh = labels != own
        if not fresh.any():
            return
        self.links += [(one, int(others[at])) for at in first[fresh]]
        if fresh.sum() == 1:
            self.component[self.component == labels[fresh][0]] = own
        else:
            self.component[np.isin(self.component, labels[fresh])] = own

    def settled(self, *members: np.ndarray) -> bool:
        own = self.component[members[0][0]]
        return all((self.component[some] == own).all() for some in members)


def _distance(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints of one or more words (the last axis)."""
    return np.bitwise_count(one ^ other).sum(axis=-1, dtype=np.int32)


def near_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints within the radius.

    The tree is built and searched in one descent: a node is a parent, its children are grouped
    by their distance to it, and members meet only in groups whose distances differ by no more
    than the radius. What is one component already needs no further search.
    """
    values = values.reshape(len(values), -1)
    forest = _Forest(len(values))

    def direct(nodes: np.ndarray, queries: np.ndarray) -> None:
        near = _distance(values[nodes][:, None], values[queries][None, :]) <= radius
        for node, row in zip(nodes, near):
            forest.link(int(node), queries[row])

    def children(parent: int, members: np.ndarray) -> list[tuple[int, np.ndarray]]:
        distance = _distance(values[members], values[parent])
        forest.link(parent, members[distance <= radius])
        return [(int(d), members[distance == d]) for d in np.unique(distance)]

    work: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(values)), None)]
    while work:
        nodes, queries = work.pop()
        if queries is None:
            if len(nodes) < 2 or forest.settled(nodes):
                continue
            if len(nodes) <= _LEAF:
                direct(nodes, nodes)
                continue
            below = children(int(nodes[0]), nodes[1:])
            for at, (distance, members) in enumerate(below):
                work.append((members, None))
                for further, others in below[at + 1 :]:
                    if further - distance <= radius:
                        work.append((members, others))
            continue
        if not len(nodes) or not len(queries) or forest.settled(nodes, queries):
            continue
        if len(nodes) * len(queries) <= _LEAF * _LEAF:
            direct(nodes, queries)
            continue
        parent = int(nodes[0])
        away = _distance(values[queries], values[parent])
        forest.link(parent, queries[away <= radius])
        distance = _distance(values[nodes[1:]], values[parent])
        for d in np.unique(distance):
            follow = np.abs(away - int(d)) <= radius
            work.append((nodes[1:][distance == d], queries[follow]))
    return forest.links


def _cuts(bits: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of near-equal parts."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _word_bytes(column: str) -> Column:
    """A long as its eight bytes, lowest first."""
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


def _keys(value: Column, radius: int) -> Column:
    """The (r+1)^2 keys of a fingerprint: a block, and a part of what remains without it."""
    found = []
    for block, (low, width) in enumerate(_cuts(64, radius + 1)):
        taken = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))
        below = value.bitwiseAND(F.lit((1 << low) - 1))
        above = F.shiftrightunsigned(value, low + width) if low + width < 64 else F.lit(0)
        rest = F.shiftleft(above.cast("long"), low).bitwiseOR(below)
        for part, (start, size) in enumerate(_cuts(64 - width, radius + 1)):
            piece = F.shiftrightunsigned(rest, start).bitwiseAND(F.lit((1 << size) - 1))
            number = block * (radius + 1) + part
            key = F.shiftleft(taken, size).bitwiseOR(piece)
            found.append(F.shiftleft(F.lit(number).cast("long"), 50).bitwiseOR(key))
    return F.array(*found)


def _shard_links(keyed: DataFrame, radius: int, shard: int, counts: DataFrame | None = None) -> DataFrame:
    """src, dst (names, src > dst): links that connect what is near among rows sharing a cell.

    ``keyed`` has cell, fp (binary, 8 bytes a word) and name; ``counts`` the rows per cell.
    """
    if counts is None:
        counts = keyed.groupBy("cell").count()
    # Counted by partial sums; only keys beyond a shard are listed, and usually none is.
    crowded = Stage(
        counts.where(F.col("count") > shard).select(
            "cell", F.ceil(F.col("count") / shard).cast("int").alias("parts")
        ),
        "crowded-keys",
    ).frame
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("fp"), parts.cast("long")).cast("int")
    placed = keyed.join(crowded, "cell", "left").withColumns({"parts": parts, "part": part})
    met = placed.select(
        "cell",
        "fp",
        "name",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("parts") - 1),
                lambda other: F.least(other, F.col("part")) * F.col("parts")
                + F.greatest(other, F.col("part")),
            )
        ).alias("pair"),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source: list[int] = []
        target: list[int] = []

        def links() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(source, pa.int64()), pa.array(target, pa.int64())], ["src", "dst"]
            )

        for group in groups(batches, ["cell", "pair"], at_least=2):
            raw = b"".join(group.column("fp").to_pylist())
            values = np.frombuffer(raw, dtype="<u8").reshape(group.num_rows, -1)
            names = group.column("name").to_numpy()
            if len(values) == 2:
                near = int(_distance(values[0], values[1])) <= radius
                found = [(0, 1)] if near else []
            else:
                found = near_links(values, radius)
            source += [int(max(names[a], names[b])) for a, b in found]
            target += [int(min(names[a], names[b])) for a, b in found]
            if len(source) > 50_000:
                yield links()
                source, target = [], []
        yield links()

    return (
        met.repartition("cell", "pair")
        .sortWithinPartitions("cell", "pair")
        .mapInArrow(search, "src bigint, dst bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = 3,
    shard: int = SHARD,
) -> DataFrame:
    """One row per row of ``docs``: key, _row, fp, component_id (smallest key reachable).

    Null texts are empty; texts without words have fingerprint 0 and link like others. Rows with
    one key count as one document. A row without a key has no component and links nothing. An
    empty table gives an empty result; other columns are not read.
    """
    marked = Stage(fingerprints(docs, key, text, words), "fingerprints").frame
    # Copies and equal fingerprints become one class before anything is compared.
    classes = Stage(
        marked.where(F.col("_key").isNotNull())
        .groupBy("fp")
        .agg(F.min("_key").alias("name"), F.max("_key").alias("last")),
        "fingerprint-classes",
    ).frame
    # Rows with one key under several fingerprints are one document.
    same = (
        marked.where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("low <> high")
        .select("_key")
        .join(marked, "_key")
        .join(classes, "fp")
        .where("_key > name")
        .select(F.col("_key").alias("src"), F.col("name").alias("dst"))
    )
    keyed = classes.select(
        F.explode(_keys(F.col("fp"), radius)).alias("cell"), _word_bytes("fp").alias("fp"), "name"
    )
    links = Stage(_shard_links(keyed, radius, shard).union(same).distinct(), "links").frame
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    components = connected_components(ends, links).select(
        F.col("id").alias("name"), "component"
    )
    # Only classes whose name is not their single member's own key are looked up.
    found = (
        classes.join(components, "name", "left")
        .withColumn("component", F.coalesce("component", "name"))
        .where((F.col("component") != F.col("name")) | (F.col("last") != F.col("name")))
        .select("fp", "component")
    )
    return marked.join(found, "fp", "left").select(
        F.col("_key").alias(key),
        "_row",
        "fp",
        F.when(F.col("_key").isNotNull(), F.coalesce("component", "_key")).alias("component_id"),
    )


#: Words of the fingerprint that leaves out pairs which are far apart.
JUDGE_WORDS = 16

#: Candidates share all BAND_ROWS smallest hashes of one of BANDS bands, and the fingerprint sees them
#: at LENIENT or above, far below any similarity asked for.
BANDS, BAND_ROWS, LENIENT = 24, 5, 0.55

#: Documents and shingles of a part of candidates that are compared exactly.
PART_ROWS, PART_SHINGLES = 512, 1 << 19

#: Texts with a word.
_HAS_WORDS = r"[^\x20\x09-\x0D]"

#: Bytes of shingle sets that a worker hands on at a time.
_HANDED = 1 << 23

#: Odd multipliers, one for each order of the shingles.
_ORDERS = np.random.default_rng(_SEED).integers(0, 1 << 31, BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _radius(similarity: float, bits: int) -> int:
    """Bits in which fingerprints of two shingle sets of this Jaccard similarity differ."""
    cosine = 2 * similarity / (1 + similarity)
    return round(bits * math.acos(cosine) / math.pi)


def band_cells(hashes: np.ndarray) -> list[int]:
    """One cell a band: the hash of the band's smallest shingles, each in an order of its own."""
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(_ORDERS), np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(short), _MIXED):
        mixed = short[None, start : start + _MIXED] * _ORDERS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    rows = least.astype("<u4").reshape(BANDS, BAND_ROWS)
    cells = np.fromiter((xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)), np.uint64, BANDS)
    return cells.view(np.int64).tolist()


def exact_links(
    sets: list[np.ndarray], similarity: float, asking: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets (sorted, distinct) whose Jaccard similarity suffices.

    With ``asking``, pairs of sets that do not ask are not looked at.
    """
    sizes = np.array([len(some) for some in sets])
    forest = _Forest(len(sets))
    numbers, place = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    has = np.zeros(len(numbers), dtype=np.int32)
    for at in range(len(sets)) if asking is None else np.flatnonzero(asking):
        if (forest.component == forest.component[at]).all():
            break
        own = place[starts[at] : starts[at] + sizes[at]]
        has[own] = 1
        common = np.add.reduceat(has[place], starts)
        has[own] = 0
        near = common >= similarity * (sizes + sizes[at] - common) - 1e-9
        near[at] = False
        forest.link(int(at), np.flatnonzero(near))
    return forest.links


def _compared(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """src, dst (src > dst) of pairs of one cell that are as similar as asked for, as forests.

    ``placed`` has cell, pair, name and asking (whether a row is compared with all of its group or
    only with those that ask); ``sets`` name and shingles.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cell", "pair"], at_least=2):
            names = group.column("name").to_numpy()
            found = exact_links(
                [np.frombuffer(raw.as_buffer(), dtype="<u8") for raw in group.column("shingles")],
                similarity,
                group.column("asking").to_numpy(),
            )
            pairs = [(int(max(names[a], names[b])), int(min(names[a], names[b]))) for a, b in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["src", "dst"]
            )

    return (
        placed.join(sets, "name")
        .select("cell", "pair", "name", "asking", "shingles")
        .repartition("cell", "pair")
        .sortWithinPartitions("cell", "pair")
        .mapInArrow(search, "src bigint, dst bigint")
    )


def _components(links: DataFrame) -> DataFrame:
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return connected_components(ends, links)


def _similar_links(
    coarse: DataFrame, sets: DataFrame, similarity: float, part_rows: int
) -> DataFrame:
    """src, dst that connect what is similar among candidates; ``coarse`` has name, cell, size.

    A cell's rows are divided into parts, each with the cell's first row, which unites the parts of
    a large group of copies. Where a divided cell stays in several pieces, rows outside its
    largest piece are compared with all rows of the cell, block by block.
    """
    cells = Stage(
        coarse.groupBy("cell").agg(
            F.min("name").alias("first"),
            F.greatest(
                F.ceil(F.count(F.lit(1)) / part_rows), F.ceil(F.sum("size") / PART_SHINGLES)
            )
            .cast("int")
            .alias("parts"),
        ),
        "candidate-cells",
    ).frame
    placed = coarse.join(cells, "cell").select(
        "cell",
        "name",
        F.lit(True).alias("asking"),
        F.explode(
            F.when(F.col("name") == F.col("first"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("name"), F.col("parts").cast("long")).cast("int"))
            )
        ).alias("pair"),
    )
    links = Stage(_compared(placed, sets, similarity).distinct(), "similar-links").frame
    divided = cells.where("parts > 1")
    if divided.isEmpty():
        return links
    united = _components(links).withColumnRenamed("id", "name")
    pieces = Stage(
        coarse.join(divided.select("cell"), "cell")
        .join(united, "name", "left")
        .withColumn("piece", F.coalesce("component", "name"))
        .select("cell", "name", "size", "piece"),
        "pieces",
    ).frame
    largest = (
        pieces.groupBy("cell", "piece")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"))
        .groupBy("cell")
        .agg(
            F.max_by("piece", F.struct("rows", "piece")).alias("major"),
            (F.sum("rows") - F.max("rows")).alias("minor_rows"),
            F.sum("rows").alias("all_rows"),
            F.sum("size").alias("all_size"),
        )
        .where("minor_rows > 0")
    )
    # Blocks of rows outside the largest piece (down) meet blocks of all rows (across).
    blocks = largest.select(
        "cell",
        "major",
        F.greatest(F.ceil(F.col("all_rows") / part_rows), F.ceil(F.col("all_size") / PART_SHINGLES))
        .alias("across"),
        F.greatest(
            F.ceil(F.col("minor_rows") / part_rows),
            F.least(F.col("minor_rows"), F.ceil(F.col("all_size") / PART_SHINGLES)),
        ).alias("down"),
    )
    rows = pieces.join(Stage(blocks, "blocks").frame, "cell").withColumns(
        {"low": F.pmod(F.xxhash64("name"), "down"), "wide": F.pmod(F.xxhash64("name", F.lit(1)), "across")}
    )
    zero = F.lit(0).cast("long")
    asked = rows.select(
        "cell",
        "name",
        F.lit(False).alias("asking"),
        F.explode(
            F.transform(F.sequence(zero, F.col("down") - 1), lambda low: low * F.col("across") + F.col("wide"))
        ).alias("pair"),
    )
    asks = rows.where("piece <> major").select(
        "cell",
        "name",
        F.lit(True).alias("asking"),
        F.explode(
            F.transform(F.sequence(zero, F.col("across") - 1), lambda wide: F.col("low") * F.col("across") + wide)
        ).alias("pair"),
    )
    grid = asked.union(asks).groupBy("cell", "pair", "name").agg(F.max("asking").alias("asking"))
    return links.union(Stage(_compared(grid, sets, similarity).distinct(), "cross-links").frame)


def similar_documents(
    docs: DataFrame,
    text: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    shard: int = SHARD,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """_row and group (the smallest _row reachable) of rows similar to another row.

    Documents are linked from a Jaccard similarity of their sets of word shingles on, decided by
    the sets themselves. Candidates share one of 24 bands of five smallest hashes over the same
    shingles: two sets at 0.8 miss all bands with a probability of 0.0001, however their
    differences are placed, and ones above with less. A wide fingerprint only leaves out pairs that
    it sees below 0.55. Below a ``similarity`` of 0.7 more than 1 % of pairs would be missed, so
    none is accepted. Texts without words are like no other.
    """
    if not 0.7 <= similarity <= 1:
        raise ValueError("similarity must be between 0.7 and 1")
    ship_package(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        schema = pa.schema(
            [
                ("_row", pa.int64()),
                ("same", pa.binary()),
                ("size", pa.int64()),
                ("fp", pa.binary()),
                ("cells", pa.list_(pa.int64())),
                ("shingles", pa.binary()),
            ]
        )
        for batch in batches:
            made, held = [], 0
            for row, raw in zip(batch.column("_row").to_pylist(), batch.column("_text")):
                hashes = np.unique(shingle_hashes(raw.as_py(), words))
                if not len(hashes):
                    continue
                data = hashes.astype("<u8").tobytes()
                judge = wide_fingerprint(hashes, JUDGE_WORDS).astype("<u8").tobytes()
                same = xxhash.xxh3_128_digest(data)
                made.append((row, same, len(hashes), judge, band_cells(hashes), data))
                held += len(data)
                if held > _HANDED:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*made), schema.types)), schema=schema)
                    made, held = [], 0
            if made:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*made), schema.types)), schema=schema)

    plain = docs.select(row_number().alias("_row"), as_bytes(text).alias("_text"))
    marked = Stage(
        plain.mapInArrow(
            build,
            "_row bigint, same binary, size bigint, fp binary, cells array<bigint>, shingles binary",
        ),
        "shingle-sets",
    ).frame
    # Equal sets are one class, however many rows have them.
    classes = Stage(
        marked.groupBy("same").agg(
            F.min(F.struct("_row", "size", "fp", "cells")).alias("one"), F.count(F.lit(1)).alias("copies")
        ),
        "wide-classes",
    ).frame
    cells = classes.select(F.explode("one.cells").alias("cell"), F.col("one._row").alias("name"))
    shared = Stage(cells.groupBy("cell").count().where("count > 1"), "shared-bands").frame
    # Most bands belong to one class: fingerprints travel only to bands that are shared.
    places = cells.join(shared.select("cell"), "cell", "left_semi")
    keyed = places.join(classes.select(F.col("one._row").alias("name"), F.col("one.fp").alias("fp")), "name")
    radius = _radius(LENIENT, JUDGE_WORDS * 64)
    candidates = Stage(_shard_links(keyed, radius, shard, shared), "candidates").frame
    coarse = Stage(
        _components(candidates)
        .select(F.col("id").alias("name"), F.col("component").alias("cell"))
        .join(classes.select(F.col("one._row").alias("name"), F.col("one.size").alias("size")), "name"),
        "candidate-groups",
    ).frame
    sets = marked.select(F.col("_row").alias("name"), "shingles")
    components = _components(_similar_links(coarse, sets, similarity, part_rows))
    grouped = (
        classes.join(components.withColumnRenamed("id", "name"), F.col("one._row") == F.col("name"), "left")
        .where("name is not null or copies > 1")
        .select("same", F.coalesce("component", "one._row").alias("group"))
    )
    return marked.select("_row", "same").join(grouped, "same").select("_row", "group")


def keep_one(docs: DataFrame, text: str = "text", radius: int | None = None, **how) -> DataFrame:
    """The first row of each group of similar documents, with all its columns.

    With ``radius``, rows are linked by their SimHash fingerprints within that many bits
    (``near_duplicates``) as well, and groups are those of both kinds of links. Rows that are similar
    to no other stay, as do null texts and texts without words.
    """
    links = None
    if radius is not None:
        # First, and without what it staged on its way, so that the disk holds one search at a time.
        path = shared_folder(docs.sparkSession, "fingerprint-links")
        since = staged_count()
        worded = docs.select(row_number().alias(ROW), text).where(F.col(text).rlike(_HAS_WORDS))
        near = near_duplicates(worded, ROW, text, radius=radius).where(F.col(ROW) != F.col("component_id"))
        near.select(F.col(ROW).alias("src"), F.col("component_id").alias("dst")).write.parquet(path)
        discard_staged(since)
        links = docs.sparkSession.read.schema("src bigint, dst bigint").parquet(path)
    similar = similar_documents(docs, text, **how).where(F.col("_row") != F.col("group"))
    similar = similar.select(F.col("_row").alias("src"), F.col("group").alias("dst"))
    if links is not None:
        both = Stage(links.union(similar).distinct(), "near-links").frame
        similar = _components(both).where("id <> component").select(F.col("id").alias("src"))
    dropped = Stage(similar.select(F.col("src").alias(ROW)), "similar-rows").frame
    return without(docs, dropped)
