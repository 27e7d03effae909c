"""Dense row numbers in file order, without a global sort.

Spark reads a file in splits. A row's place is (file, split start, place in split), and all
three are known inside the scan: the first two from the file metadata, the third from the
order in which the task emits rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import store

FILE, START, SEQUENCE = "_file", "_start", "_seq"

#: Offsets of file splits are sent to every executor up to this size, about a million splits at
#: the estimated size of one. Beyond it rows are joined by shuffle on their split.
BROADCAST_BYTES, _SPLIT_BYTES = 64 << 20, 64

_FILE_ID = "_file_id"


def with_file_order(frame: DataFrame) -> DataFrame:
    """Add the place of each row to a frame read directly from files."""
    return frame.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(START),
        F.monotonically_increasing_id().alias(SEQUENCE),
    )


def splits_in_order():
    """Window over one row per split; its size is the number of splits, not of rows."""
    return Window.orderBy(FILE, START)


def join_splits(placed: DataFrame, per_split: DataFrame) -> DataFrame:
    """Join one row per split, found by a 64-bit file id so that the broadcast stays compact.

    The size is checked, and so is that no two files share an id; otherwise the join is a
    shuffle on the file name.
    """
    keyed = per_split.withColumn(_FILE_ID, F.xxhash64(FILE)).drop(FILE)
    found = keyed.agg(
        F.count(F.lit(1)).alias("splits"), F.count_distinct(_FILE_ID, START).alias("ids")
    ).first()
    if found["ids"] < found["splits"] or found["splits"] * _SPLIT_BYTES > BROADCAST_BYTES:
        return placed.join(per_split, [FILE, START])
    return (
        placed.withColumn(_FILE_ID, F.xxhash64(FILE))
        .join(F.broadcast(keyed), [_FILE_ID, START])
        .drop(_FILE_ID)
    )


def _offsets(placed: DataFrame) -> DataFrame:
    """Per split: its first sequence number and the number of rows in earlier splits."""
    earlier = splits_in_order().rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy(FILE, START)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(SEQUENCE).alias("_first"))
        .select(
            FILE,
            START,
            "_first",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )


def number_rows(frame: DataFrame, name: str) -> DataFrame:
    """Put ``name`` = 1..n in file order in front of a frame read directly from files.

    The placed rows are stored once, since split boundaries may differ when the files are
    scanned a second time. The summary reads three of their columns; after that only one
    (first, offset) pair per split is joined and no row is shuffled.
    """
    placed = store(with_file_order(frame))
    number = F.col("_before") + F.col(SEQUENCE) - F.col("_first") + F.lit(1)
    return join_splits(placed, _offsets(placed)).select(
        number.alias(name), *frame.columns
    )


def number_kept_rows(placed: DataFrame, name: str) -> DataFrame:
    """The same for stored rows that were filtered after placing, so their numbers have gaps.

    The position inside a split needs a window, which holds one split of text; a compressed
    file that cannot be split is one split.
    """
    in_split = Window.partitionBy(FILE, START).orderBy(SEQUENCE)
    number = F.col("_before") + F.row_number().over(in_split)
    kept = [column for column in placed.columns if column not in (FILE, START, SEQUENCE)]
    return join_splits(placed, _offsets(placed)).select(
        number.alias(name), *kept
    )
