"""Reports on labelled laundering schemes.

A scheme (``pattern_group``) may hold any share of the rows: every report reduces a scheme by
partial aggregation, or counts its distinct banks through a (scheme, bank) shuffle, and never
brings the rows of one scheme together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.clock import DAY_SECONDS, HOUR_SECONDS, epoch_seconds


def _rows() -> Column:
    return F.count(F.lit(1))


def type_sizes(patterns: DataFrame) -> DataFrame:
    """q6: schemes and rows per raw type."""
    return (
        patterns.groupBy("pattern_type")
        .agg(
            F.count_distinct("pattern_group").alias("n_patterns"), _rows().alias("n_transactions")
        )
        .orderBy(F.col("n_transactions").desc(), "pattern_type")
    )


def _banks_per_scheme(patterns: DataFrame) -> DataFrame:
    """pattern_group, pattern_type, n_banks."""
    touched = patterns.select(
        "pattern_group",
        "pattern_type",
        F.explode(F.array_distinct(F.array("from_bank", "to_bank"))).alias("bank"),
    )
    # Two plain levels: the (scheme, bank) level spreads a large scheme over many tasks.
    return (
        touched.groupBy("pattern_group", "bank")
        .agg(F.max("pattern_type").alias("pattern_type"))
        .groupBy("pattern_group")
        .agg(F.max("pattern_type").alias("pattern_type"), _rows().alias("n_banks"))
    )


def bank_spread(patterns: DataFrame) -> DataFrame:
    """q9: schemes per number of distinct banks."""
    return (
        _banks_per_scheme(patterns)
        .groupBy("n_banks")
        .agg(_rows().alias("n_patterns"))
        .orderBy("n_banks")
    )


def bank_spread_by_type(patterns: DataFrame) -> DataFrame:
    """q18: schemes per raw type and number of distinct banks."""
    return (
        _banks_per_scheme(patterns)
        .groupBy("pattern_type", "n_banks")
        .agg(_rows().alias("n_patterns"))
        .orderBy("pattern_type", "n_banks")
    )


def scheme_durations(patterns: DataFrame) -> DataFrame:
    """q14: first-to-last span of each scheme."""
    span = epoch_seconds(F.max("ts")) - epoch_seconds(F.min("ts"))
    return patterns.groupBy("pattern_group").agg(
        F.max("pattern_type").alias("pattern_type"),
        span.alias("duration_seconds"),
        F.round(span / F.lit(float(HOUR_SECONDS)), 2).alias("duration_hours"),
        F.round(span / F.lit(float(DAY_SECONDS)), 2).alias("duration_days"),
    )


def cross_bank_share(patterns: DataFrame) -> DataFrame:
    """b6: intra-bank and inter-bank edges per raw type."""
    per_scheme = patterns.groupBy("pattern_group").agg(
        F.max("pattern_type").alias("pattern_type"),
        F.count_if(F.col("from_bank") == F.col("to_bank")).alias("intra"),
        F.count_if(F.col("from_bank") != F.col("to_bank")).alias("inter"),
    )
    return (
        per_scheme.groupBy("pattern_type")
        .agg(
            _rows().alias("n_patterns"),
            F.count_if(F.col("inter") > 0).alias("n_with_inter_edge"),
            F.sum("intra").alias("total_intra_edges"),
            F.sum("inter").alias("total_inter_edges"),
        )
        .orderBy(
            (F.col("total_intra_edges") + F.col("total_inter_edges")).desc(), "pattern_type"
        )
    )


def value_by_type(patterns: DataFrame, currency: str = "US Dollar") -> DataFrame:
    """b14: rows, schemes and amount moved per raw type, one currency only."""
    return (
        patterns.where(F.col("payment_currency") == currency)
        .groupBy("pattern_type")
        .agg(
            _rows().alias("n_transactions"),
            F.count_distinct("pattern_group").alias("n_pattern_instances"),
            F.sum("amount_paid").cast("double").alias("total_usd"),
        )
    )
