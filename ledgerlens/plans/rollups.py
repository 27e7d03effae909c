"""Chart tables computed from the report tables.

Their inputs are report results whose size is set by categories, bins, banks or schemes, not
by ledger rows. Windows here run over such rows only; each function says what bounds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.draw import drawn
from ledgerlens.functions.binning import (
    BANK_SPREAD_EDGES,
    BANK_SPREAD_LABELS,
    COMPONENT_SIZE_LABELS,
    bin_by_edges,
)
from ledgerlens.functions.labels import CANONICAL_TYPES, bank_label, canonical_type
from ledgerlens.functions.rates import percent, ratio
from ledgerlens.operators.ordering import global_row_number, running_total
from ledgerlens.operators.profiles import bank_profile

# Labels of the amount bins, weekday order of the calendar chart.
AMOUNT_BIN_LABELS = {
    -1: "<$1",
    0: "$1–10",
    1: "$10–100",
    2: "$100–1K",
    3: "$1K–10K",
    4: "$10K–100K",
    5: "$100K–1M",
    6: "$1M–10M",
    7: "$10M–100M",
    8: "$100M–1B",
    9: "$1B+",
}
WEEKDAYS = {2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat", 1: "Sun"}
COVERAGE_POINTS = [5, 10, 20, 50]
SCATTER_SHARE = 0.025


def _of_class(value: int, column: str, amount: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(column) == value, F.col(amount))), F.lit(0))


def _canonical(report: DataFrame) -> DataFrame:
    return report.withColumn("canonical", canonical_type(F.col("pattern_type")))


def _charted_types(report: DataFrame) -> DataFrame:
    """Only the eight canonical types appear in the charts by type."""
    return report.where(F.col("canonical").isin(CANONICAL_TYPES))


def daily_rate_percent(daily: DataFrame) -> DataFrame:
    """Daily flagged share in percent."""
    return daily.select("day", F.round(F.col("rate") * F.lit(100.0), 4).alias("rate_pct"))


def bank_rank_size(ledger: DataFrame) -> DataFrame:
    """Banks numbered by size; numbering is distributed, the number of banks is open."""
    sizes = bank_profile(ledger, flags=False).select(
        "bank", (F.col("out_tx") + F.col("in_tx")).alias("tx_count")
    )
    return global_row_number(sizes, [F.col("tx_count").desc(), F.col("bank").asc()], "rank")


def format_share(by_format: DataFrame) -> DataFrame:
    """Clean and flagged share of each payment format, riskiest first."""
    clean, flagged = F.col("clean"), F.col("flagged")
    return (
        by_format.groupBy("payment_format")
        .agg(
            _of_class(0, "is_laundering", "n").alias("clean"),
            _of_class(1, "is_laundering", "n").alias("flagged"),
        )
        .select(
            "payment_format",
            percent(clean, clean + flagged).alias("legitimate_pct"),
            percent(flagged, clean + flagged).alias("laundering_pct"),
        )
        .orderBy(F.col("laundering_pct").desc(), "payment_format")
    )


def share_within_class(report: DataFrame, scope: str) -> DataFrame:
    """R2: share of each scope within its class (four rows at most)."""
    whole = F.sum("n").over(Window.partitionBy("is_laundering"))
    return report.select("is_laundering", scope, "n", percent(F.col("n"), whole).alias("share_pct"))


def canonical_sizes(by_type: DataFrame) -> DataFrame:
    """Schemes and rows per canonical type, rows per scheme to one decimal."""
    return (
        _canonical(by_type)
        .groupBy("canonical")
        .agg(
            F.sum("n_patterns").alias("n_patterns"),
            F.sum("n_transactions").alias("n_transactions"),
        )
        .withColumn(
            "avg_tx_per_pattern", F.round(ratio(F.col("n_transactions"), F.col("n_patterns")), 1)
        )
        .orderBy(F.col("n_transactions").desc(), "canonical")
    )


def busiest_banks(risk: DataFrame, by: str, min_total: int = 100, k: int = 20) -> DataFrame:
    """The ``k`` banks with most rows on one side, small banks left out."""
    return (
        risk.where(F.col("in_transactions") + F.col("out_transactions") >= min_total)
        .orderBy(F.col(by).desc(), "bank_id")
        .limit(k)
        .select(
            "bank_id",
            bank_label(F.col("bank_id"), F.col("name")).alias("label"),
            "in_transactions",
            "out_transactions",
            "laundering_ratio",
        )
    )


def bank_spread_summary(spread: DataFrame) -> DataFrame:
    """Most frequent number of banks, largest number, share of single-bank schemes."""
    total = F.sum("n_patterns")
    single = F.coalesce(F.sum(F.when(F.col("n_banks") == 1, F.col("n_patterns"))), F.lit(0))
    mode_key = F.struct(F.col("n_patterns"), -F.col("n_banks"))
    return spread.agg(
        F.max_by("n_banks", mode_key).alias("mode_banks"),
        F.max("n_patterns").alias("mode_patterns"),
        F.max("n_banks").alias("max_banks"),
        single.alias("intra_patterns"),
        total.alias("total_patterns"),
        F.round(single * 100 / F.nullif(total, F.lit(0)), 2).alias("intra_pct"),
    )


def _two_class_percent(groups: Sequence[str]) -> list[Column]:
    """Shares of ``clean`` and ``flagged`` within each group, in percent."""
    whole = Window.partitionBy(*groups)
    return [
        percent(F.col("clean"), F.sum("clean").over(whole)).alias("legitimate_pct"),
        percent(F.col("flagged"), F.sum("flagged").over(whole)).alias("laundering_pct"),
    ]


def _by_bin(report: DataFrame, keys: Sequence[str], label: str, amount: str) -> DataFrame:
    return report.groupBy(*keys).agg(
        _of_class(0, label, amount).alias("clean"), _of_class(1, label, amount).alias("flagged")
    )


def amount_shape(decades: DataFrame, k: int = 6) -> DataFrame:
    """Amount distribution of each class in the ``k`` most used currencies.

    The windows see one row per currency and amount bin.
    """
    labels = F.create_map(*[F.lit(x) for pair in AMOUNT_BIN_LABELS.items() for x in pair])
    bins = _by_bin(decades, ["payment_currency", "log10_bin"], "is_laundering", "n").withColumn(
        "rows", F.sum(F.col("clean") + F.col("flagged")).over(Window.partitionBy("payment_currency"))
    )
    by_use = Window.orderBy(F.col("rows").desc(), F.col("payment_currency").asc())
    top = bins.withColumn("place", F.dense_rank().over(by_use)).where(F.col("place") <= k)
    return top.select(
        "payment_currency",
        "log10_bin",
        F.element_at(labels, F.col("log10_bin")).alias("bin_label"),
        *_two_class_percent(["payment_currency"]),
    )


def class_density(
    report: DataFrame,
    bin_column: str,
    label: str = "is_laundering",
    amount: str = "n",
    all_bins: int | None = None,
) -> DataFrame:
    """Share of each bin within its class; with ``all_bins``, bins 0..all_bins-1 without
    rows appear as zero. The window spans the bins of one histogram."""
    bins = _by_bin(report, [bin_column], label, amount)
    if all_bins is not None:
        spine = report.sparkSession.range(all_bins).select(
            F.col("id").cast("int").alias(bin_column)
        )
        bins = spine.join(bins, bin_column, "left").fillna(0, ["clean", "flagged"])
    return bins.select(bin_column, *_two_class_percent([]))


def weekday_grid(by_hour: DataFrame) -> DataFrame:
    """Flagged share per weekday (Monday first) and hour; hours without rows are zero."""
    names = F.create_map(*[F.lit(x) for pair in WEEKDAYS.items() for x in pair])
    position = F.pmod(F.col("day_of_week") + 5, F.lit(7)) + 1
    grid = (
        by_hour.groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.max("rate"))
    )
    hours = [
        F.coalesce(F.col(str(hour)), F.lit(0.0)).alias(f"h{hour:02d}") for hour in range(24)
    ]
    return grid.select(
        position.cast("int").alias("position"),
        F.element_at(names, F.col("day_of_week")).alias("weekday"),
        *hours,
    ).orderBy("position")


def duration_boxes(durations: DataFrame) -> DataFrame:
    """Box-plot figures of the scheme durations per canonical type, in hours.

    The percentile keeps one counter per distinct duration; durations are rounded to 0.01 h,
    so their number is set by the time span of the ledger and not by the number of schemes.
    """
    clipped = _charted_types(
        _canonical(durations).select(
            "canonical", F.greatest("duration_hours", F.lit(0.01)).alias("hours")
        )
    )
    quartiles = clipped.groupBy("canonical").agg(
        F.count(F.lit(1)).alias("n_patterns"),
        F.percentile("hours", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
    )
    quartiles = quartiles.select(
        "canonical",
        "n_patterns",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    inside = (F.col("hours") >= F.col("q1") - reach) & (F.col("hours") <= F.col("q3") + reach)
    # At most eight rows on the broadcast side.
    return (
        clipped.join(F.broadcast(quartiles), "canonical")
        .groupBy("canonical", "n_patterns", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("hours"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("hours"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .withColumns({name: F.round(name, 6) for name in ("q1", "median", "q3")})
    )


def degree_ccdf(degrees: DataFrame) -> DataFrame:
    """Share of accounts with at least this degree, per direction and label.

    Distinct degrees number at most the square root of twice the rows; the running sum is
    blocked all the same.
    """
    groups = ["direction", "ever_laundering"]
    upto = running_total(degrees, groups, "deg", "n_accounts", "_upto", total="_all")
    return upto.select(
        *groups,
        "deg",
        ratio(F.col("_all") - F.col("_upto") + F.col("n_accounts"), F.col("_all")).alias("ccdf"),
    )


def ordered_component_buckets(components: DataFrame) -> DataFrame:
    """Component buckets with their position on the size axis."""
    order = F.array(*[F.lit(label) for label in COMPONENT_SIZE_LABELS])
    return components.select(
        F.array_position(order, F.col("size_bucket")).cast("int").alias("position"),
        *components.columns,
    ).orderBy("position")


def bank_spread_grid(spread_by_type: DataFrame) -> DataFrame:
    """Schemes per canonical type and range of bank counts; all eight types appear."""
    bucket = bin_by_edges(F.col("n_banks"), BANK_SPREAD_EDGES, BANK_SPREAD_LABELS)
    counts = (
        _canonical(spread_by_type.withColumn("bucket", bucket))
        .groupBy("canonical")
        .pivot("bucket", BANK_SPREAD_LABELS)
        .agg(F.sum("n_patterns"))
    )
    types = F.array(*[F.lit(name) for name in CANONICAL_TYPES])
    spine = spread_by_type.sparkSession.range(len(CANONICAL_TYPES)).select(
        F.element_at(types, (F.col("id") + 1).cast("int")).alias("canonical")
    )
    cells = [
        F.coalesce(F.col(f"`{label}`"), F.lit(0)).alias(f"banks_{name}")
        for label, name in zip(BANK_SPREAD_LABELS, ["1", "2", "3_5", "6_10", "11_20", "21_up"])
    ]
    return spine.join(counts, "canonical", "left").select("canonical", *cells)


def currency_grid(pairs: DataFrame, k: int = 10) -> DataFrame:
    """Square grid of the ``k`` most used currencies per class, empty cells as zero."""
    legs = pairs.select(
        F.explode(F.array("payment_currency", "receiving_currency")).alias("currency"), "n"
    )
    top = (
        legs.groupBy("currency")
        .agg(F.sum("n").alias("rows"))
        .orderBy(F.col("rows").desc(), "currency")
        .limit(k)
    )
    # One row holding at most k names; expanding it gives the 2 x k x k cells of the chart.
    cells = (
        top.agg(F.collect_list("currency").alias("names"))
        .select("names", F.explode("names").alias("payment_currency"))
        .select("payment_currency", F.explode("names").alias("receiving_currency"))
        .select(
            "payment_currency",
            "receiving_currency",
            F.explode(F.array(F.lit(0), F.lit(1))).alias("is_laundering"),
        )
    )
    keys = ["payment_currency", "receiving_currency", "is_laundering"]
    return (
        cells.join(pairs.select(*keys, "n"), keys, "left")
        .fillna(0, ["n"])
        .withColumn("log10_n", F.round(F.log10(F.col("n") + F.lit(1)), 6))
    )


def top_corridors(corridors: DataFrame, by: str, k: int = 25) -> DataFrame:
    """The ``k`` first corridors by ``n_total`` or by ``laundering_rate``."""
    return (
        corridors.orderBy(F.col(by).desc(), "from_bank", "to_bank")
        .limit(k)
        .select(
            F.concat_ws(" -> ", F.col("from_bank"), F.col("to_bank")).alias("corridor"),
            "n_total",
            "n_laundering",
            "laundering_rate",
        )
    )


def visibility_by_type(visibility: DataFrame) -> DataFrame:
    """Mean visible fraction of a scheme per canonical type and data-sharing set-up."""

    def mean_fraction(column: str) -> Column:
        return F.round(F.avg(ratio(F.col(column), F.col("n_edges_total"))), 6)

    return (
        _charted_types(_canonical(visibility))
        .groupBy("canonical")
        .agg(
            F.count(F.lit(1)).alias("n_patterns"),
            mean_fraction("isolated_visible_edges").alias("isolated"),
            F.max(F.lit(1.0)).alias("shared"),
            mean_fraction("loose_consortium_edges").alias("consort_loose"),
            mean_fraction("strict_consortium_edges").alias("consort_strict"),
        )
    )


def coverage_curve(histogram: DataFrame) -> DataFrame:
    """Share of a class covered by the ``k`` largest banks (k is a dense rank, so the
    running sum is cut into blocks of ranks)."""
    groups = ["coverage_type", "is_laundering"]
    upto = running_total(histogram, groups, "k", "n_at_k", "_upto", total="_all")
    return upto.select(
        *groups, "k", percent(F.col("_upto"), F.col("_all")).alias("coverage_pct")
    )


def coverage_at(histogram: DataFrame, points: Sequence[int] = COVERAGE_POINTS) -> DataFrame:
    """The coverage curve at a few membership sizes, one column per size."""
    whole = F.sum("n_at_k")
    return histogram.groupBy("coverage_type", "is_laundering").agg(
        *[
            percent(
                F.coalesce(F.sum(F.when(F.col("k") <= point, F.col("n_at_k"))), F.lit(0)), whole
            ).alias(f"k{point}_pct")
            for point in points
        ]
    )


def cross_bank_by_type(shares: DataFrame) -> DataFrame:
    """Intra- and inter-bank edges per canonical type, smallest type first."""
    return (
        _charted_types(_canonical(shares))
        .groupBy("canonical")
        .agg(
            F.sum("n_patterns").alias("n_patterns"),
            F.sum("n_with_inter_edge").alias("n_with_inter_edge"),
            F.sum("total_intra_edges").alias("total_intra"),
            F.sum("total_inter_edges").alias("total_inter"),
        )
        .withColumns(
            {
                "frac_inter_instances": ratio(F.col("n_with_inter_edge"), F.col("n_patterns")),
                "total_edges": F.col("total_intra") + F.col("total_inter"),
            }
        )
        .orderBy("total_edges", "canonical")
    )


def value_by_canonical_type(patterns: DataFrame, currency: str = "US Dollar") -> DataFrame:
    """Rows, schemes and amount moved per canonical type. Summed from the labelled rows,
    so the amount stays a decimal until the end; a scheme counts once per raw type."""
    return (
        _charted_types(_canonical(patterns.where(F.col("payment_currency") == currency)))
        .groupBy("canonical")
        .agg(
            F.count(F.lit(1)).alias("n_transactions"),
            F.count_distinct("pattern_type", "pattern_group").alias("n_pattern_instances"),
            F.sum("amount_paid").cast("double").alias("total_usd"),
        )
    )


def scatter_accounts(degrees: DataFrame, share: float = SCATTER_SHARE) -> DataFrame:
    """A share of the accounts, drawn by a hash of their names so that the draw repeats."""
    return degrees.where(drawn("account", share))


def log_matrix(flows: DataFrame, source: str, target: str) -> DataFrame:
    """Corridor counts on a log axis, in long form."""
    return flows.select(
        source, target, "n", F.round(F.log10(F.col("n") + F.lit(1)), 6).alias("log10_n")
    )
