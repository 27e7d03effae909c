"""Data quality: counts, checks, class balance, guards, constraint checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_rows(frame: DataFrame, name: str) -> None:
    """Stop early when a table that must not be empty is empty."""
    if frame.isEmpty():
        raise ValueError(f"{name} holds no rows")


def require_positives(frame: DataFrame, label: str = "label") -> None:
    """Stop early when a training table has no positive rows."""
    if frame.where(F.col(label) == 1).isEmpty():
        raise ValueError("the training rows hold no positive example")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def sample_rows_by_key(frame: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """D3: the first ``rows`` rows in key order (a display sample that repeats)."""
    return frame.orderBy(key).limit(rows)


def _checks(frame: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check_name, value: all checks of one table from one aggregation."""
    names = list(checks)
    row = frame.agg(*[value.alias(f"_{i}") for i, value in enumerate(checks.values())])
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").cast("string").alias("value"))
        for i, name in enumerate(names)
    ]
    return row.select(F.inline(F.array(*pairs)))


def sanity_checks(
    ledger: DataFrame, patterns: DataFrame, approximate: bool = False
) -> DataFrame:
    """Row counts, flagged percentage, distinct values, time range, partitions, banks.

    ``approximate`` counts distinct values with a sketch instead of exactly.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    rows = F.count(F.lit(1))
    percentage = F.round(
        F.sum("is_laundering").cast("double") * 100.0 / F.nullif(rows, F.lit(0)), 4
    )
    text = "yyyy-MM-dd HH:mm:ss"
    ledger_checks = _checks(
        ledger,
        {
            "transactions row count": rows,
            "transactions laundering ratio": F.format_string("%.4f", percentage),
            "distinct payment_format values": distinct("payment_format"),
            "min timestamp": F.date_format(F.min("ts"), text),
            "max timestamp": F.date_format(F.max("ts"), text),
            "transactions partition count": distinct("txn_date"),
            "transactions distinct from_bank": distinct("from_bank"),
        },
    )
    pattern_checks = _checks(
        patterns,
        {
            "laundering_patterns row count": rows,
            "distinct pattern_type values": distinct("pattern_type"),
        },
    )
    return ledger_checks.unionByName(pattern_checks)


def class_balance(frame: DataFrame, label: str = "label") -> DataFrame:
    """Positives, total, percentage."""
    positives, total = F.sum(F.col(label).cast("bigint")), F.count(F.lit(1))
    return frame.agg(
        F.coalesce(positives, F.lit(0)).alias("positives"),
        total.alias("total"),
        F.coalesce(
            F.round(positives * F.lit(100.0) / F.nullif(total, F.lit(0)), 4), F.lit(0.0)
        ).alias("positive_pct"),
    )


def cardinalities(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, n_distinct (non-NULL), by a two-level shuffle per (column, value)."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
            for name in columns
        ]
    )
    return (
        frame.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def constraint_violation(frame: DataFrame, label: str = "is_laundering") -> Column:
    """First violated constraint of a row as text, NULL for a valid row."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"{name} is null")) for name in frame.columns
    ]
    bad_label = F.when(~F.col(label).isin(0, 1), F.lit(f"{label} is not 0 or 1"))
    return F.coalesce(*missing, bad_label)


def split_valid(frame: DataFrame, label: str = "is_laundering") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``reason``)."""
    checked = frame.withColumn("reason", constraint_violation(frame, label))
    valid = checked.where(F.col("reason").isNull()).drop("reason")
    return valid, checked.where(F.col("reason").isNotNull())


def assert_valid(frame: DataFrame, label: str = "is_laundering") -> DataFrame:
    """S4, strict: the same rows, and the job fails on the first violation it meets."""
    reason = constraint_violation(frame, label)
    return frame.where(
        F.assert_true(reason.isNull(), F.concat(F.lit("constraint: "), reason)).isNull()
    )
