"""Distinct counts and quantiles from sketches that are stored per day and merged afterwards.

A day's sketch is a few kilobytes whatever the day's rows, so a report over any range of days
merges stored sketches and reads no transfer again; a reloaded day replaces its own sketch only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct sketch: relative standard error 1.04 / sqrt(2**14), 0.8 %.
REGISTERS = 14

#: Size parameter of a quantile sketch; its rank error is about 2.3 / k (99 % confidence).
QUANTILE_SIZE = 400
RANK_ERROR = 2.3 / QUANTILE_SIZE


def daily_sketches(
    ledger: DataFrame, distinct: Sequence[str], quantiles: Sequence[str], day: str = "txn_date"
) -> DataFrame:
    """One row per day: its rows, a distinct sketch per column of ``distinct`` (as text) and a
    quantile sketch per whole-number column of ``quantiles``."""
    return ledger.groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(name).cast("string"), REGISTERS).alias(f"hll_{name}") for name in distinct],
        *[F.kll_sketch_agg_bigint(F.col(name).cast("bigint"), QUANTILE_SIZE).alias(f"kll_{name}") for name in quantiles],
    )


def merged_distinct(daily: DataFrame, name: str) -> DataFrame:
    """Number of days, their rows, and the estimated distinct values over all of them."""
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg(f"hll_{name}")).alias("estimate"),
    )


def merged_quantiles(daily: DataFrame, name: str, fractions: Sequence[float]) -> DataFrame:
    """Fraction and estimated quantile over all days of ``daily``."""
    merged = daily.agg(F.kll_merge_agg_bigint(f"kll_{name}").alias("sketch"))
    found = [
        F.struct(
            F.lit(one).alias("fraction"),
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(one)).alias("estimate"),
        )
        for one in fractions
    ]
    return merged.select(F.inline(F.array(*found)))


def distinct_check(ledger: DataFrame, daily: DataFrame, name: str) -> DataFrame:
    """The merged estimate against the exact count: within four standard errors, or not."""
    exact = ledger.agg(F.count_distinct(name).alias("exact"))
    bound = 4 * 1.04 / math.sqrt(1 << REGISTERS)
    off = F.abs(F.col("estimate") - F.col("exact"))
    # One row on each side, put into one without a join.
    both = merged_distinct(daily, name).unionByName(exact, allowMissingColumns=True)
    both = both.agg(*[F.max(column).alias(column) for column in ("days", "n", "estimate", "exact")])
    return both.select(
        F.lit(name).alias("column"), "days", "n", "exact",
        (off <= F.greatest(F.lit(1.0), F.lit(bound) * F.col("exact"))).alias("within_bound"),
    )


def quantile_check(ledger: DataFrame, daily: DataFrame, name: str, fractions: Sequence[float]) -> DataFrame:
    """Whether the exact rank of each merged quantile is within the rank error of its fraction.

    The ranks of all estimates come from one scan: rows below each, and up to each.
    """
    found = {row["fraction"]: row["estimate"] for row in merged_quantiles(daily, name, fractions).collect()}
    value = F.col(name).cast("bigint")
    # A value with many rows covers a range of ranks.
    ranks = ledger.agg(
        F.count(value).alias("n"),
        *[F.count_if(value < found[one]).alias(f"below_{at}") for at, one in enumerate(fractions)],
        *[F.count_if(value <= found[one]).alias(f"upto_{at}") for at, one in enumerate(fractions)],
    )
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(one).alias("fraction"),
            F.col("n"),
            (
                (F.col(f"below_{at}") <= F.lit(one + RANK_ERROR) * F.col("n"))
                & (F.col(f"upto_{at}") >= F.lit(one - RANK_ERROR) * F.col("n"))
            ).alias("within_bound"),
        )
        for at, one in enumerate(fractions)
    ]
    return ranks.select(F.inline(F.array(*cells)))
