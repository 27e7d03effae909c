"""Range binning built from ordinary conditional expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bin edges and bin labels of the published reports.
AMOUNT_DECADE_EDGES = [1, 10, 100, 1000, 10000, 100000, 1000000, 10000000, 100000000, 1000000000]
AMOUNT_DECADE_LABELS = [-1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
GAP_EDGES_SECONDS = [1, 60, 3600, 86400, 604800]
GAP_LABELS = [-1, 0, 1, 2, 3, 4]
LIFETIME_EDGES_DAYS = [1, 2, 4, 7, 11, 14]
LIFETIME_LABELS = [0, 1, 2, 3, 4, 5, 6]
COMPONENT_SIZE_EDGES = [2, 3, 10, 100, 1000, 10000, 100000, 1000000]
COMPONENT_SIZE_LABELS = [
    "1", "2", "3-9", "10-99", "100-999", "1K-9.9K", "10K-99.9K", "100K-999K", "1M+",
]
BANK_SPREAD_EDGES = [2, 3, 6, 11, 21]
BANK_SPREAD_LABELS = ["1", "2", "3-5", "6-10", "11-20", "21+"]


def bin_by_edges(value: Column, edges: Sequence, labels: Sequence) -> Column:
    """Label of the half-open range ``value`` falls in: ``labels[i]`` below ``edges[i]``.

    ``labels`` has one entry more than ``edges``; the last one takes everything else.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    chain = F.when(value < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        chain = chain.when(value < F.lit(edge), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def fixed_width_bin(value: Column, width: int) -> Column:
    """Lower bound of the fixed-width histogram bin holding ``value``."""
    return (F.floor(value / F.lit(width)) * F.lit(width)).cast("int")
