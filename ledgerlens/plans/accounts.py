"""Reports on accounts: degrees, lifetimes, pass-through times, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.binning import (
    COMPONENT_SIZE_EDGES,
    COMPONENT_SIZE_LABELS,
    GAP_EDGES_SECONDS,
    GAP_LABELS,
    LIFETIME_EDGES_DAYS,
    LIFETIME_LABELS,
    bin_by_edges,
)
from ledgerlens.functions.clock import DAY_SECONDS, day_number, epoch_seconds
from ledgerlens.operators.components import account_graph, connected_components
from ledgerlens.operators.profiles import account_profile, ever_flagged


def account_degrees(ledger: DataFrame) -> DataFrame:
    """q5: rows sent and received per account, and whether it was ever part of a flagged row."""
    return account_profile(ledger).select(
        "account", "out_deg", "in_deg", ever_flagged().alias("ever_laundering")
    )


def degree_histogram(ledger: DataFrame) -> DataFrame:
    """q15: accounts per degree, per direction; the label is that of the direction."""

    def side(name: str, degree: str, label: str):
        return F.struct(
            F.lit(name).alias("direction"),
            F.col(label).alias("ever_laundering"),
            F.col(degree).alias("deg"),
        )

    sides = F.array(side("out", "out_deg", "out_flagged"), side("in", "in_deg", "in_flagged"))
    return (
        account_profile(ledger)
        .select(F.inline(sides))
        .where(F.col("deg") > 0)
        .groupBy("direction", "ever_laundering", "deg")
        .agg(F.count(F.lit(1)).alias("n_accounts"))
    )


def lifetime_histogram(ledger: DataFrame) -> DataFrame:
    """b15: accounts per lifetime bucket (first to last row, in days) and label."""
    days = (epoch_seconds(F.col("last_ts")) - epoch_seconds(F.col("first_ts"))) / F.lit(
        float(DAY_SECONDS)
    )
    return (
        account_profile(ledger, times=True)
        .groupBy(
            ever_flagged().alias("ever_laundering"),
            bin_by_edges(days, LIFETIME_EDGES_DAYS, LIFETIME_LABELS).alias("lifetime_bucket"),
        )
        .agg(F.count(F.lit(1)).alias("n_accounts"))
    )


def _account_seconds(ledger: DataFrame) -> DataFrame:
    """One row per account and second: did money come in, did it go out, and the label of the
    first transfer out. Within a second the order is: all ins, then outs by ``txn_id``."""
    second = epoch_seconds(F.col("ts"))
    nothing = F.lit(None)
    came_in = F.struct(
        F.col("to_account").alias("account"),
        second.alias("t"),
        F.lit(1).alias("has_in"),
        F.lit(0).alias("has_out"),
        nothing.cast("bigint").alias("out_id"),
        nothing.cast("int").alias("out_label"),
    )
    went_out = F.struct(
        F.col("from_account").alias("account"),
        second.alias("t"),
        F.lit(0).alias("has_in"),
        F.lit(1).alias("has_out"),
        F.col("txn_id").cast("bigint").alias("out_id"),
        F.col("is_laundering").cast("int").alias("out_label"),
    )
    return (
        ledger.select(F.inline(F.array(came_in, went_out)))
        .groupBy("account", "t")
        .agg(
            F.max("has_in").alias("has_in"),
            F.max("has_out").alias("has_out"),
            F.min_by("out_label", "out_id").alias("out_label"),
        )
    )


def pass_through_gaps(ledger: DataFrame) -> DataFrame:
    """Every (in, next event is out) pair of an account: label of the out, gap in seconds.

    An account may hold any share of the ledger, so its events are first merged per second
    (map-side, at most 86,400 rows per account and day remain). Neighbouring seconds are then
    paired inside one day. The first second of a day is paired with the last second of the
    previous active day by looking at first and last seconds only: no window exceeds a day of
    seconds or two rows per active day.
    """
    in_day = Window.partitionBy("account", "day").orderBy("t")
    seconds = (
        _account_seconds(ledger)
        .withColumn("day", day_number(F.col("t")))
        .select(
            "account",
            "t",
            "has_in",
            "has_out",
            "out_label",
            F.lag("t").over(in_day).alias("prev_t"),
            F.lag("has_out").over(in_day).alias("prev_out"),
            F.lead("t").over(in_day).alias("next_t"),
        )
    )
    # The last second of the previous active day is the previous row among the edge rows.
    over_days = Window.partitionBy("account").orderBy("t")
    first_of_day = (
        seconds.where(F.col("prev_t").isNull() | F.col("next_t").isNull())
        .select(
            "account",
            "t",
            "has_in",
            "has_out",
            "out_label",
            F.lag("t").over(over_days).alias("edge_t"),
            F.lag("has_out").over(over_days).alias("edge_out"),
            "prev_t",
        )
        .where(F.col("prev_t").isNull())
        .select("t", "has_in", "has_out", "out_label", "edge_t", "edge_out")
    )
    later_in_day = seconds.where(F.col("prev_t").isNotNull()).select(
        "t", "has_in", "has_out", "out_label", "prev_t", "prev_out"
    )
    # Inside one second the ins come first; between two seconds the earlier one must have
    # ended with an in (no out at all) and the later one must start with an out (no in).
    # The two cases exclude each other, so a second closes at most one gap.
    gap = F.when(
        (F.col("has_in") == 1) & (F.col("has_out") == 1), F.lit(0).cast("bigint")
    ).when((F.col("prev_out") == 0) & (F.col("has_in") == 0), F.col("t") - F.col("prev_t"))
    return (
        later_in_day.union(first_of_day)
        .select(F.col("out_label").alias("is_laundering"), gap.alias("gap_sec"))
        .where(F.col("gap_sec").isNotNull())
    )


def pass_through_histogram(ledger: DataFrame) -> DataFrame:
    """q17: pass-through gaps in time decades per label of the outgoing row."""
    decade = bin_by_edges(F.col("gap_sec"), GAP_EDGES_SECONDS, GAP_LABELS)
    return (
        pass_through_gaps(ledger)
        .groupBy("is_laundering", decade.alias("decade"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("is_laundering", "decade")
    )


def component_sizes(ledger: DataFrame) -> DataFrame:
    """component, size: weakly connected components of the account graph."""
    vertices, edges = account_graph(ledger)
    return (
        connected_components(vertices, edges)
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("size"))
    )


def component_histogram(ledger: DataFrame) -> DataFrame:
    """q16: components per size bucket."""
    bucket = bin_by_edges(F.col("size"), COMPONENT_SIZE_EDGES, COMPONENT_SIZE_LABELS)
    return (
        component_sizes(ledger)
        .groupBy(bucket.alias("size_bucket"))
        .agg(
            F.count(F.lit(1)).alias("n_components"),
            F.sum("size").alias("n_vertices_in_bucket"),
            F.max("size").alias("max_size_in_bucket"),
        )
        .orderBy("size_bucket")
    )
