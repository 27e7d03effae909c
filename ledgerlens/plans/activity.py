"""Reports on the ledger as a whole: time, format, currency, amount.

All of these are one scan of two to four columns, map-side partial aggregation, and a shuffle
of at most a few thousand group rows per task, whatever the skew of the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.binning import (
    AMOUNT_DECADE_EDGES,
    AMOUNT_DECADE_LABELS,
    bin_by_edges,
    fixed_width_bin,
)
from ledgerlens.functions.labels import bank_scope, currency_scope
from ledgerlens.functions.rates import rounded_ratio


def _rows() -> Column:
    return F.count(F.lit(1))



def _totals() -> list[Column]:
    flagged = F.sum("is_laundering")
    return [
        _rows().alias("total"),
        flagged.alias("laundering"),
        rounded_ratio(flagged, _rows()).alias("rate"),
    ]


def daily_rate(ledger: DataFrame) -> DataFrame:
    """q1: share of flagged rows per day."""
    return ledger.groupBy(F.col("txn_date").alias("day")).agg(*_totals()).orderBy("day")


def format_by_label(ledger: DataFrame) -> DataFrame:
    """q2: rows per payment format and label."""
    return ledger.groupBy("payment_format", "is_laundering").agg(_rows().alias("n"))


def scope_by_label(ledger: DataFrame) -> DataFrame:
    """q4: intra-bank and inter-bank rows per label."""
    return ledger.groupBy("is_laundering", bank_scope().alias("scope")).agg(_rows().alias("n"))


def amount_decades(ledger: DataFrame) -> DataFrame:
    """q11: positive amounts in powers of ten, per currency and label."""
    decade = bin_by_edges(F.col("amount_paid"), AMOUNT_DECADE_EDGES, AMOUNT_DECADE_LABELS)
    return (
        ledger.where(F.col("amount_paid") > 0)
        .groupBy("payment_currency", "is_laundering", decade.alias("log10_bin"))
        .agg(
            _rows().alias("n"),
            F.round(F.min("amount_paid"), 2).cast("double").alias("bin_min"),
            F.round(F.max("amount_paid"), 2).cast("double").alias("bin_max"),
        )
        .orderBy("payment_currency", "is_laundering", "log10_bin")
    )


def hour_by_weekday(ledger: DataFrame) -> DataFrame:
    """q12: share of flagged rows per hour and weekday (1 = Sunday)."""
    return (
        ledger.groupBy(
            F.hour("ts").alias("hour_of_day"), F.dayofweek("ts").alias("day_of_week")
        )
        .agg(*_totals())
        .orderBy("day_of_week", "hour_of_day")
    )


def currency_scope_by_label(ledger: DataFrame) -> DataFrame:
    """q13: same-currency and cross-currency rows per label."""
    return ledger.groupBy("is_laundering", currency_scope().alias("currency_scope")).agg(
        _rows().alias("n")
    )


def currency_pairs(ledger: DataFrame) -> DataFrame:
    """q19: rows and paid amount per currency pair and label."""
    return (
        ledger.groupBy("payment_currency", "receiving_currency", "is_laundering")
        .agg(_rows().alias("n"), F.sum("amount_paid").cast("double").alias("total_amount"))
        .orderBy(F.col("n").desc(), "payment_currency", "receiving_currency", "is_laundering")
    )


def structuring_histogram(
    ledger: DataFrame,
    low: int = 7000,
    high: int = 12000,
    width: int = 50,
    currency: str | None = None,
) -> DataFrame:
    """b1: narrow amount bins around a reporting threshold, both ends included.

    All currencies count alike, as published, unless one is named.
    """
    rows = ledger if currency is None else ledger.where(F.col("payment_currency") == currency)
    return (
        rows.where(F.col("amount_paid").between(low, high))
        .groupBy("is_laundering", fixed_width_bin(F.col("amount_paid"), width).alias("bin_lo"))
        .agg(_rows().alias("n"))
        .orderBy("is_laundering", "bin_lo")
    )


def hourly_by_label(ledger: DataFrame) -> DataFrame:
    """b16: rows per hour of day and label."""
    return (
        ledger.groupBy(F.hour("ts").alias("hour_of_day"), "is_laundering")
        .agg(_rows().alias("n"))
        .orderBy("hour_of_day", "is_laundering")
    )
