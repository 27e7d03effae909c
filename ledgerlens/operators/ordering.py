"""Global order without a global window: numbering, running totals, exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id: row position in the low 33 bits

DAY = 86400


def global_row_number(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Append ``name``: 1..n over the whole frame in ``order`` (which must be a total order).

    The rows are range-partitioned and sorted in place, so each task numbers its own slice;
    only one count per slice is summed up across slices. The sliced rows are checkpointed
    first because partition ids may differ when a plan is evaluated a second time.
    """
    sliced = materialise(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)) + F.lit(1)
        )
    )
    # One row per slice, so this window sees at most as many rows as there are partitions.
    before = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_rows").over(
                    Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select("_slice", "_before")
    )
    return (
        sliced.join(before, "_slice")
        .withColumn(name, (F.col("_before") + F.col("_pos")).cast("int"))
        .select(*frame.columns, name)
    )


def ranked_totals(frame: DataFrame, order: Sequence[Column], values: dict[str, str]) -> DataFrame:
    """Append, for every ``new: old`` of ``values``, the sum of ``old`` over all rows up to this one.

    ``order`` must be a total order. As in ``global_row_number``, each task sums its own slice of
    the range-partitioned rows, and only one total per slice is summed up across slices.
    """
    sliced = materialise(
        frame.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    )
    upto = (Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(*upto)
    # One row per slice, so this window sees at most as many rows as there are partitions.
    slices = Window.orderBy("_slice").rowsBetween(*upto)
    before = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(old).alias(f"_{new}") for new, old in values.items()])
        .select("_slice", *[(F.sum(f"_{new}").over(slices) - F.col(f"_{new}")).alias(f"_{new}") for new in values])
    )
    local = sliced.withColumns({new: F.sum(old).over(within) for new, old in values.items()})
    return local.join(before, "_slice").select(
        *frame.columns, *[(F.col(new) + F.col(f"_{new}")).alias(new) for new in values]
    )


def running_total(
    frame: DataFrame,
    groups: Sequence[str],
    key: str,
    value: str,
    name: str,
    total: str | None = None,
    block: int = 10_000,
) -> DataFrame:
    """Append ``name``: the sum of ``value`` over all rows of the group with a key up to this one.
    With ``total``, append the sum over the whole group under that name as well.

    ``key`` is an integer that is unique within a group. It is cut into blocks of ``block``
    consecutive values; each block is summed in its own window and shifted by the total of
    the earlier blocks, so no window holds more than ``block`` rows of data.
    """
    blocked = frame.withColumn("_block", F.floor(F.col(key) / F.lit(block)))
    group = Window.partitionBy(*groups)
    upto = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (
        blocked.groupBy(*groups, "_block")
        .agg(F.sum(value).alias("_sum"))
        .select(
            *groups,
            "_block",
            (F.sum("_sum").over(upto) - F.col("_sum")).alias("_shift"),
            F.sum("_sum").over(group).alias("_whole"),
        )
    )
    local = F.sum(value).over(
        Window.partitionBy(*groups, "_block")
        .orderBy(key)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    outputs = [(F.col("_local") + F.col("_shift")).alias(name)]
    if total:
        outputs.append(F.col("_whole").alias(total))
    return (
        blocked.withColumn("_local", local)
        .join(blocks, [*groups, "_block"])
        .select(*frame.columns, *outputs)
    )


def _upto(order: str):
    return Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def time_quantile(frame: DataFrame, column: str, fraction: float) -> int | None:
    """Exact discrete quantile of an epoch-seconds column (the first value whose share of
    rows up to it reaches ``fraction``), or None for an empty frame.

    The first pass counts rows per day and finds the day of the quantile, the second counts
    rows per second inside that day only. The windows run over one row per calendar day and
    over at most 86,400 seconds, whatever the number of rows; one row per pass comes back.
    """
    second = F.col(column)
    days = (
        frame.groupBy(F.floor(second / F.lit(DAY)).cast("long").alias("day"))
        .agg(F.count(second).alias("n"))
        .where(F.col("day").isNotNull())
        .select(
            "day",
            (F.sum("n").over(_upto("day")) - F.col("n")).alias("before"),
            F.sum("n").over(_upto("day")).alias("upto"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
    )
    found = days.where(F.col("upto") / F.col("total") >= F.lit(fraction)).orderBy("day").first()
    if found is None:
        return None
    start = found["day"] * DAY
    share = (F.lit(found["before"]) + F.sum("n").over(_upto("sec"))) / F.lit(found["total"])
    row = (
        frame.where((second >= start) & (second < start + DAY))
        .groupBy(second.alias("sec"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("sec", share.alias("share"))
        .where(F.col("share") >= F.lit(fraction))
        .agg(F.min("sec").alias("cut"))
        .first()
    )
    return int(row["cut"])


def approximate_time_quantile(
    frame: DataFrame, column: str, fraction: float, error: float = 0.001
) -> int | None:
    """Sketch-based quantile for callers who prefer one pass over exactness."""
    found = frame.approxQuantile(column, [fraction], error)
    return int(found[0]) if found else None
