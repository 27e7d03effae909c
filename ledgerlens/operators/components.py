"""Weakly connected components by alternating star contraction (Kiveris et al., 2014).

Every vertex keeps pointing at smaller neighbours until each component is one star around its
smallest account. A round is two group-minimum + join steps; both are ordinary shuffles, and a
hub account is handled by partial aggregation on the minimum side and by the runtime skew-join
split on the edge side. Rounds grow with the logarithm of the graph, not with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import store


def account_graph(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices: id) and (edges: src >= dst) of the undirected account graph.

    Parallel and opposite transfers become one edge, self-transfers stay. The edges are stored,
    so the ledger is scanned and de-duplicated once for the vertices and for all rounds.
    """
    ends = ("from_account", "to_account")
    edges = store(
        ledger.select(F.greatest(*ends).alias("src"), F.least(*ends).alias("dst")).distinct()
    )
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return vertices, edges


def _attach_minimum(edges: DataFrame) -> DataFrame:
    """Add ``low``: the smallest account among ``src`` and its neighbours ``dst``."""
    low = edges.groupBy("src").agg(F.min("dst").alias("low"))
    return edges.join(low, "src").withColumn("low", F.least("src", "low"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src"), F.col("dst")),
                F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
            )
        )
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a vertex to the vertex's smallest neighbour."""
    return (
        _attach_minimum(_both_ways(edges))
        .where(F.col("dst") > F.col("src"))
        .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a vertex and its smaller neighbours to the smallest of them."""
    with_low = _attach_minimum(edges)
    moved = F.array(
        F.struct(F.col("dst").alias("src"), F.col("low").alias("dst")),
        F.struct(F.col("src"), F.col("low").alias("dst")),
    )
    return with_low.select(F.inline(moved)).where(F.col("src") != F.col("dst")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """True when every vertex points at one centre and no centre points anywhere.

    The contraction keeps components connected, so such a forest is the final answer.
    """
    degree = (
        edges.select(
            F.inline(
                F.array(
                    F.struct(F.col("src").alias("v"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                    F.struct(F.col("dst").alias("v"), F.lit(0).alias("o"), F.lit(1).alias("i")),
                )
            )
        )
        .groupBy("v")
        .agg(F.sum("o").alias("o"), F.max("i").alias("i"))
    )
    return degree.where((F.col("o") > 1) | ((F.col("o") > 0) & (F.col("i") > 0))).isEmpty()


def connected_components(
    vertices: DataFrame, edges: DataFrame, max_rounds: int = 100
) -> DataFrame:
    """id, component for every vertex; ``component`` is the smallest id of its component.

    ``edges`` as ``account_graph`` returns them: each pair once, the larger id in ``src``.

    Each round is stored in the shared folder, so a lost executor costs at most one round.
    """
    # A vertex with self-loops only has no link and stays alone.
    links = edges.where(F.col("src") != F.col("dst"))
    for _ in range(max_rounds):
        links = store(_small_star(_large_star(links)))
        if _is_star_forest(links):
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return vertices.join(links.withColumnRenamed("src", "id"), "id", "left").select(
        "id", F.coalesce("dst", "id").alias("component")
    )
