"""Raw tables to warehouse tables: types, dates, active window, layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.plans.quality import assert_valid, split_valid
from ledgerlens.sources.ordering import number_rows

DAY_MILLIS = 86_400_000
BUCKETS = 16


def load_transfers(raw: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Numbered ledger rows from a frame read directly from CSV files.

    Strict mode fails on the first row that breaks a constraint. Otherwise the broken rows are
    returned apart, with a reason; numbers follow the file order of all rows either way.
    """
    numbered = number_rows(raw, "txn_id")
    if strict:
        return assert_valid(numbered), None
    return split_valid(numbered)


def load_pattern_rows(raw: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame | None]:
    numbered = number_rows(raw, "pattern_id")
    if strict:
        return assert_valid(numbered), None
    return split_valid(numbered)


def _typed(shifted: Column) -> dict[str, Column]:
    return {
        "ts": F.timestamp_millis(shifted),
        "amount_received": F.col("amount_received").cast(schema.AMOUNT),
        "amount_paid": F.col("amount_paid").cast(schema.AMOUNT),
        "is_laundering": F.col("is_laundering").cast("int"),
    }


def warehouse_transactions(
    raw: DataFrame, until: str | None = None, shift_millis: int = 0
) -> DataFrame:
    """Ledger rows with ``timestamp`` in epoch millis and amounts as text, typed.

    ``shift_millis`` corrects millis that were encoded in another zone. ``until`` is the last
    day kept; the date comes from the millis, so the filter needs no time zone.
    """
    shifted = F.col("timestamp") + F.lit(shift_millis)
    day = F.floor(shifted / F.lit(DAY_MILLIS)).cast("int")
    typed = raw.withColumn("txn_date", F.date_add(F.lit("1970-01-01").cast("date"), day))
    if until is not None:
        typed = typed.where(F.col("txn_date") <= F.lit(until).cast("date"))
    return typed.withColumns(_typed(shifted)).select(*schema.TRANSACTIONS.names)


def warehouse_patterns(raw: DataFrame, shift_millis: int = 0) -> DataFrame:
    """Labelled transfers, typed; no window applies to them."""
    shifted = F.col("timestamp") + F.lit(shift_millis)
    return raw.withColumns(_typed(shifted)).select(*schema.LAUNDERING_PATTERNS.names)


def with_date(ledger: DataFrame, until: str | None = None) -> DataFrame:
    """The same for rows that already carry a TIMESTAMP: partition date and active window."""
    dated = ledger.withColumn("txn_date", F.to_date("ts"))
    return dated if until is None else active_window(dated, until)


def active_window(ledger: DataFrame, until: str) -> DataFrame:
    """Rows up to and including a day; a range on the partition column, so it prunes."""
    return ledger.where(F.col("txn_date") <= F.lit(until).cast("date"))


def save_ledger(ledger: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Managed table by day, hashed on the sending bank.

    Rows are rebalanced on (day, bucket) first: small cells are joined into one file, and a
    cell swollen by a large bank is split over several tasks and files at run time.
    """
    bucket = F.pmod(F.hash("from_bank"), F.lit(buckets))
    (
        ledger.withColumn("_cell", bucket)
        .hint("rebalance", "txn_date", "_cell")
        .drop("_cell")
        .write.mode("overwrite")
        .format("parquet")
        .option("compression", "snappy")
        .partitionBy("txn_date")
        .bucketBy(buckets, "from_bank")
        .saveAsTable(table)
    )


def save_ledger_files(ledger: DataFrame, path: str) -> None:
    """The same by day as plain files; a reload replaces the days it contains.

    The session runs with dynamic partition overwrite, so other days stay.
    """
    (
        ledger.hint("rebalance", "txn_date")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("txn_date")
        .parquet(path)
    )


def reload_days(rows: DataFrame, path: str) -> None:
    """Replace the days that ``rows`` holds in a ledger saved by day; all other days stay.

    Says so on the write itself, so it holds whatever the session is set to.
    """
    (
        rows.hint("rebalance", "txn_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("txn_date")
        .parquet(path)
    )


def save_bucketed(
    frame: DataFrame, table: str, key: str, path: str, buckets: int = BUCKETS
) -> DataFrame:
    """An external table at ``path``, hashed on ``key`` into files that joins can rely on.

    One task writes one bucket, so the files of a bucket are few. Two tables with equal buckets
    on their join keys are joined, and either is grouped by its key, without a shuffle.
    """
    (
        frame.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .option("compression", "snappy")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return frame.sparkSession.table(table)
