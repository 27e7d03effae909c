"""Laundering-attempt text files to rows, as a distributed job.

A file is a list of blocks: a BEGIN line with the scheme type, transfer lines, an END line.
Which block a line belongs to depends on all lines before it. Lines are therefore placed by
file split; inside a split a window finds the last marker, and across splits only one summary
row per split is carried on. A split holds at most ``spark.sql.files.maxPartitionBytes`` of
text, so no task sees more than that, however long a file or a block is; a compressed file that
cannot be split is one split, and should be kept small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.session import store
from ledgerlens.sources.ordering import (
    FILE,
    SEQUENCE,
    START,
    join_splits,
    number_kept_rows,
    splits_in_order,
    with_file_order,
)

# The marker lines and the number of fields of the published text format.
BEGIN_LINE = r"(?i)^BEGIN\s+LAUNDERING\s+ATTEMPT\s*-\s*(.+?)\s*$"
END_LINE = r"(?i)^END\s+LAUNDERING\s+ATTEMPT"
FIELD_COUNT = 11

RAW_COLUMNS = ["timestamp", *schema.TRANSFER_COLUMNS[1:]]


@dataclass
class ParsedSchemes:
    """rows: pattern_group, pattern_type and 11 text fields; rejects: line, reason, group.

    ``placed`` holds the rows together with their place in the files.
    """

    rows: DataFrame
    placed: DataFrame
    rejects: DataFrame
    summary: DataFrame  # one row: n_groups, n_rows


def _marked_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in place with ``opens`` (0/1) and ``marker``: 'B' + type, 'E', or NULL."""
    text = F.col("value")
    opens = text.rlike(BEGIN_LINE)
    kind = F.upper(F.trim(F.regexp_extract(text, BEGIN_LINE, 1)))
    marker = F.when(opens, F.concat(F.lit("B"), kind)).when(text.rlike(END_LINE), F.lit("E"))
    return (
        with_file_order(spark.read.text(path))
        .withColumns({"opens": opens.cast("int"), "marker": marker})
        .where(~text.rlike(r"^\s*$"))
    )


def parse_scheme_text(
    spark: SparkSession, path: str | list[str], blocks_span_files: bool = False
) -> ParsedSchemes:
    """Rows of all blocks; blocks are numbered from 1 in (file, line) order.

    Files are independent texts, or, with ``blocks_span_files``, parts of one text in the order
    of their names, so that a large scheme may run over several of them.
    """
    lines = store(_marked_lines(spark, path))
    marked_at = F.when(F.col("marker").isNotNull(), F.col(SEQUENCE))
    splits = lines.groupBy(FILE, START).agg(
        F.sum("opens").alias("_opened"), F.max_by("marker", marked_at).alias("_last")
    )
    earlier = splits_in_order().rowsBetween(Window.unboundedPreceding, -1)
    # Group numbers run on over files; an open block does so only when asked.
    earlier_in_file = Window.partitionBy(FILE).orderBy(START).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = earlier if blocks_span_files else earlier_in_file
    entry = splits.select(
        FILE,
        START,
        F.coalesce(F.sum("_opened").over(earlier), F.lit(0)).alias("_groups_before"),
        F.last("_last", ignorenulls=True).over(carried).alias("_open_before"),
    )
    in_split = (
        Window.partitionBy(FILE, START)
        .orderBy(SEQUENCE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    state = F.coalesce(
        F.last("marker", ignorenulls=True).over(in_split), F.col("_open_before")
    )
    inside = (
        join_splits(lines, entry)
        .withColumns(
            {
                "_state": state,
                "pattern_group": (
                    F.col("_groups_before") + F.sum("opens").over(in_split)
                ).cast("int"),
            }
        )
        .where(F.col("marker").isNull() & F.col("_state").startswith("B"))
        .select(
            "pattern_group",
            F.expr("substring(_state, 2)").alias("pattern_type"),
            "value",
            F.split("value", ",", -1).alias("_fields"),
            FILE,
            START,
            SEQUENCE,
        )
    )
    whole = F.size("_fields") == FIELD_COUNT
    placed = inside.where(whole).select(
        "pattern_group",
        "pattern_type",
        *[F.col("_fields")[i].alias(name) for i, name in enumerate(RAW_COLUMNS)],
        FILE,
        START,
        SEQUENCE,
    )
    rows = placed.drop(FILE, START, SEQUENCE)
    rejects = inside.where(~whole).select(
        "pattern_group",
        F.concat(F.lit("fields: "), F.size("_fields")).alias("reason"),
        F.col("value").alias("line"),
    )
    n_rows = rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("_one", F.lit(1))
    n_groups = lines.agg(
        F.coalesce(F.sum("opens"), F.lit(0)).alias("n_groups")
    ).withColumn("_one", F.lit(1))
    # One row joined to one row.
    return ParsedSchemes(rows, placed, rejects, n_groups.join(n_rows, "_one").drop("_one"))


def typed_scheme_rows(parsed: ParsedSchemes, timestamp_format: str) -> DataFrame:
    """Labelled transfers with their declared types, numbered in file order."""
    kinds = {field.name: field.dataType for field in schema.LAUNDERING_PATTERNS.fields}
    typed = number_kept_rows(parsed.placed, "pattern_id").withColumn(
        "ts", F.to_timestamp("timestamp", timestamp_format)
    )
    return typed.select(
        *[F.col(name).cast(kinds[name]).alias(name) for name in schema.LAUNDERING_PATTERNS.names]
    )
