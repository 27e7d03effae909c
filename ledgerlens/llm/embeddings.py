"""Near-duplicate vectors by an exact metric range join.

Distances are angles, which are a metric, so the triangle inequality bounds them. Pivots (a bounded
sample of the vectors) cut the vectors of a label into cells, each vector belonging to its nearest
pivot. A vector x can be within the range e of a member of another cell c only if
d(x, pivot c) <= radius of c + e and d(x, pivot c) <= d(x, own pivot) + 2e; to those cells it is
copied. Every cell then compares its own vectors with its members, without any other cell.

Equal vectors are merged first and counted by their number. In spaces of many dimensions without
clusters, angles to pivots differ little and most vectors are copied to most cells of their label:
the result stays exact, the work then nears that of comparing all vectors of a label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.sorted_groups import groups
from ledgerlens.llm.staging import Stage, ship_package
from ledgerlens.operators.components import connected_components

#: Aimed-at vectors of a cell, and the most pivots that are drawn and sent to every task.
CELL_ROWS, MOST_PIVOTS = 2000, 4096

#: Own vectors a task compares at a time; larger cells are divided into such blocks.
BLOCK_ROWS = 4096

#: Other members of a cell that are compared at a time.
_CHUNK = 4096

#: Added to bounds on angles for rounding.
_SLACK = 1e-6


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([chunk.flatten().to_numpy(zero_copy_only=False) for chunk in chunks])
    matrix = flat.astype(np.float64).reshape(sum(len(chunk) for chunk in chunks), -1)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _angles(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(left @ right.T, -1.0, 1.0))


def _usable(key: str, vector: str, label: str):
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    some = F.exists(vector, lambda x: x != 0)
    return (
        F.col(key).isNotNull()
        & F.col(label).isNotNull()
        & F.coalesce(F.size(vector) > 0, F.lit(False))
        & F.coalesce(finite, F.lit(False))
        & F.coalesce(some, F.lit(False))
    )


class _Pivots:
    """The drawn pivots by (label, dimension); sent to tasks with their closure."""

    def __init__(self, rows: list):
        self.of: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        grouped: dict[tuple, list] = {}
        for number, row in enumerate(rows):
            grouped.setdefault((row["label"], row["dim"]), []).append((number, row["vector"]))
        for at, found in grouped.items():
            matrix = np.asarray([vector for _, vector in found], dtype=np.float64)
            self.of[at] = (
                np.asarray([number for number, _ in found]),
                matrix / np.linalg.norm(matrix, axis=1, keepdims=True),
            )

    def angles(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each (label, dimension) of a batch: its rows, the cells, and the angles to them."""
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for label in np.unique(labels):
            for dim in np.unique(dims[labels == label]):
                rows = np.flatnonzero((labels == label) & (dims == dim))
                cells, pivots = self.of.get((label, dim), (np.asarray([-1]), None))
                if pivots is None:  # no pivot drawn: the whole label is one cell
                    yield rows, cells, np.zeros((len(rows), 1))
                else:
                    yield rows, cells, _angles(_matrix(batch.column("vector").take(rows)), pivots)


_NODE = "name bigint, weight bigint, label bigint, dim int, vector array<double>"


def _cells(classes: DataFrame, reach: float, cell_rows: int, most_pivots: int, block_rows: int) -> DataFrame:
    """Members of cells: the columns of a class, cell, block, and whether the cell owns it."""
    total = classes.count()
    share = min(1.0 / cell_rows, most_pivots / max(total, 1) / 2)
    drawn = (
        classes.where(F.pmod(F.xxhash64("name"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .select("label", "dim", "vector", "name")
        .orderBy("label", "dim", "name")
        .limit(most_pivots)
        .collect()
    )
    pivots = _Pivots(drawn)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.full(batch.num_rows, -1, dtype=np.int32)
            away = np.zeros(batch.num_rows)
            for rows, cells, angles in pivots.angles(batch):
                nearest = angles.argmin(axis=1)
                cell[rows], away[rows] = cells[nearest], angles[np.arange(len(rows)), nearest]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("dim"), pa.array(cell), pa.array(away)],
                names=["label", "dim", "cell", "away"],
            )

    # As many rows as pivots, and one for each label without any; the latter stay on the cluster.
    shapes = (
        classes.mapInArrow(home, "label bigint, dim int, cell int, away double")
        .groupBy("label", "dim", "cell")
        .agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("own"))
    )
    shapes = Stage(shapes.withColumn("blocks", F.ceil(F.col("own") / block_rows).cast("int")), "cells").frame
    radius = {
        row["cell"]: row["radius"] for row in shapes.where("cell >= 0").select("cell", "radius").collect()
    }

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, cells, angles in pivots.angles(batch):
                own = angles.min(axis=1, keepdims=True)
                bound = np.asarray([radius.get(int(c), 0.0) for c in cells]) + reach + _SLACK
                member = (angles <= bound) & (angles <= own + 2 * reach + _SLACK)
                nearest = angles.argmin(axis=1)
                member[np.arange(len(rows)), nearest] = True
                row, at = np.nonzero(member)
                picked = pa.RecordBatch.from_struct_array(
                    batch.to_struct_array().take(pa.array(rows[row]))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *picked.columns,
                        pa.array(cells[at].astype(np.int32)),
                        pa.array((nearest[row] != at).astype(np.int32)),
                    ],
                    names=[*picked.schema.names, "cell", "guest"],
                )

    dealt = classes.mapInArrow(deal, f"{_NODE}, cell int, guest int")
    # A cell of many own vectors is compared block by block, each with all members.
    block = F.pmod(F.xxhash64("name"), F.col("blocks").cast("long")).cast("int")
    return (
        dealt.join(shapes.select("label", "dim", "cell", "blocks"), ["label", "dim", "cell"])
        .withColumn("own_block", F.when(F.col("guest") == 0, block))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .withColumn("guest", F.when(F.col("own_block") == F.col("block"), 0).otherwise(1))
        .drop("own_block", "blocks")
    )


def _compare(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """names of the own vectors, how many rows each links to, and a spanning forest of links."""
    guest = group.column("guest").to_numpy()
    names, weights = group.column("name").to_numpy(), group.column("weight").to_numpy()
    own, others = np.flatnonzero(guest == 0), np.flatnonzero(guest == 1)
    matrix = _matrix(group.column("vector").take(pa.array(own)))
    near = matrix @ matrix.T >= least
    np.fill_diagonal(near, False)
    links = near @ weights[own] + weights[own] - 1
    component = np.arange(len(own))
    forest: list[tuple[int, int]] = []

    def join(name: int, linked: np.ndarray) -> None:
        labels, first = np.unique(component[linked], return_index=True)
        forest.extend((name, int(names[own[linked[at]]])) for at in first)
        component[np.isin(component, labels)] = labels[0]

    for at in np.flatnonzero(near.any(axis=1)):
        linked = np.append(np.flatnonzero(near[at]), at)
        if (component[linked] != component[at]).any():
            join(int(names[own[at]]), linked)
    for start in range(0, len(others), _CHUNK):
        some = others[start : start + _CHUNK]
        near = matrix @ _matrix(group.column("vector").take(pa.array(some))).T >= least
        links = links + near @ weights[some]
        for at in np.flatnonzero(near.any(axis=0)):
            join(int(names[some[at]]), np.flatnonzero(near[:, at]))
    return names[own], links, [(a, b) for a, b in forest if a != b]


def range_join(classes: DataFrame, least: float, cell_rows: int, most_pivots: int, block_rows: int) -> DataFrame:
    """kind 0: (a) name and (b) rows it links to; kind 1: (a, b) links that connect, a > b."""
    reach = math.acos(least)
    members = _cells(classes, reach, cell_rows, most_pivots, block_rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["label", "dim", "cell", "block"]):
            if not (group.column("guest").to_numpy() == 0).any():
                continue
            names, links, forest = _compare(group, least)
            a = np.concatenate([names, [max(pair) for pair in forest]]).astype(np.int64)
            b = np.concatenate([links, [min(pair) for pair in forest]]).astype(np.int64)
            kind = np.repeat([0, 1], [len(names), len(forest)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(a), pa.array(b)], names=["kind", "a", "b"]
            )

    place = ["label", "dim", "cell", "block"]
    return (
        members.repartition(*place)
        .sortWithinPartitions(*place)
        .mapInArrow(compare, "kind int, a bigint, b bigint")
    )


def near_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cell_rows: int = CELL_ROWS,
    most_pivots: int = MOST_PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row: key, n_links, component_id, kept.

    Vectors of one label and dimension link from a cosine of ``least`` on. Vectors that are null,
    empty, all zero, or hold a null or non-finite number, and rows with a null label or key, link
    with nothing and are kept as they are (component_id is their key). Every row counts as a
    vector, repeated rows too. Other columns are not read; an empty table gives an empty result.
    """
    ship_package(vectors.sparkSession)
    rows = Stage(
        vectors.select(
            F.col(key).alias("_key"),
            F.col(label).cast("long").alias("label"),
            F.size(vector).alias("dim"),
            F.col(vector).cast("array<double>").alias("vector"),
            _usable(key, vector, label).alias("usable"),
        ),
        "vectors",
    ).frame
    usable = rows.where("usable")
    # Merged on the map side: a vector of very many copies is one row per task, then one class.
    classes = Stage(
        usable.groupBy("label", "dim", "vector")
        .agg(F.min("_key").cast("long").alias("name"), F.count(F.lit(1)).alias("weight"))
        .select("name", "weight", "label", "dim", "vector"),
        "vector-classes",
    ).frame
    found = Stage(range_join(classes, least, cell_rows, most_pivots, block_rows), "vector-links").frame
    links = found.where("kind = 1").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    components = connected_components(ends, links)
    # Looked up only for vectors that have a link; the rest is its own component.
    linked = (
        found.where("kind = 0 and b > 0")
        .select(F.col("a").alias("name"), F.col("b").alias("n_links"))
        .join(components.withColumnRenamed("id", "name"), "name", "left")
        .join(classes, "name")
        .select(
            "label", "dim", "vector", "n_links", F.coalesce("component", "name").alias("component")
        )
    )
    own = rows.withColumn("label", F.when(F.col("usable"), F.col("label")))
    return own.join(linked, ["label", "dim", "vector"], "left").select(
        F.col("_key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "_key").cast("long").alias("component_id"),
        F.coalesce(F.coalesce("component", "_key") == F.col("_key"), F.lit(True)).alias("kept"),
    )
