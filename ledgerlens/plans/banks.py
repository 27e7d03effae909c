"""Reports on banks and bank-to-bank corridors.

Corridor reports never join the ledger itself: the ledger is first compressed to one row per
corridor, and ranks are joined to those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.rates import ratio, rounded_ratio
from ledgerlens.operators.profiles import (
    bank_pairs,
    bank_profile,
    bank_volume,
    ranked_banks,
    top_banks,
)
from ledgerlens.session import materialise


def _total() -> Column:
    return F.col("out_tx") + F.col("in_tx")


def _flagged() -> Column:
    return F.col("out_flagged") + F.col("in_flagged")


def bank_activity(ledger: DataFrame) -> DataFrame:
    """q3: rows and flagged rows per bank over both ends."""
    return (
        bank_profile(ledger)
        .select(
            "bank",
            _total().alias("tx_count"),
            _flagged().alias("laundering_count"),
            rounded_ratio(_flagged(), _total()).alias("laundering_rate"),
        )
        .orderBy(F.col("tx_count").desc(), "bank")
    )


def _named_profile(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per bank with its name; a bank without accounts keeps a NULL name."""
    names = accounts.groupBy(F.col("bank_id").alias("_id")).agg(F.min("bank_name").alias("name"))
    profile = bank_profile(ledger)
    return profile.join(names, F.col("bank").cast("bigint") == F.col("_id"), "left").select(
        F.col("bank").alias("bank_id"),
        "name",
        F.col("in_tx").alias("in_transactions"),
        F.col("out_tx").alias("out_transactions"),
        _total().alias("total_tx"),
        rounded_ratio(_flagged(), _total()).alias("laundering_ratio"),
    )


def bank_risk(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """q8: incoming and outgoing rows and flagged share per named bank."""
    return (
        _named_profile(ledger, accounts)
        .drop("total_tx")
        .orderBy(F.col("laundering_ratio").desc(), "bank_id")
    )


def largest_banks(ledger: DataFrame, accounts: DataFrame, k: int = 20) -> DataFrame:
    """q10: the ``k`` busiest banks."""
    return (
        _named_profile(ledger, accounts)
        .orderBy(F.col("total_tx").desc(), "bank_id")
        .limit(k)
    )


def top_bank_matrix(ledger: DataFrame, k: int = 20) -> DataFrame:
    """q7: corridors between the ``k`` largest banks."""
    pairs = materialise(bank_pairs(ledger))
    # At most k rows, so the broadcast has a fixed bound.
    top = F.broadcast(top_banks(bank_volume(pairs), k).select("bank"))
    return (
        pairs.join(top.withColumnRenamed("bank", "from_bank"), "from_bank", "left_semi")
        .join(top.withColumnRenamed("bank", "to_bank"), "to_bank", "left_semi")
        .select("from_bank", "to_bank", "n", F.col("flagged").alias("laundering_n"))
    )


def top_rank_matrix(ledger: DataFrame, k: int = 500) -> DataFrame:
    """q7b: corridors between the ``k`` largest banks, addressed by rank."""
    pairs = materialise(bank_pairs(ledger))
    # The window runs over the k rows that survived the top-k, not over all banks.
    by_volume = Window.orderBy(F.col("volume").desc(), F.col("bank").asc())
    ranks = F.broadcast(
        top_banks(bank_volume(pairs), k).select(
            "bank", F.row_number().over(by_volume).alias("rnk")
        )
    )
    senders = ranks.select(F.col("bank").alias("from_bank"), F.col("rnk").alias("from_rank"))
    receivers = ranks.select(F.col("bank").alias("to_bank"), F.col("rnk").alias("to_rank"))
    return (
        pairs.join(senders, "from_bank")
        .join(receivers, "to_bank")
        .select("from_rank", "to_rank", "n", F.col("flagged").alias("laundering_n"))
    )


def busy_corridors(ledger: DataFrame, min_rows: int = 1000) -> DataFrame:
    """q20: corridors with at least ``min_rows`` rows and their flagged share."""
    return (
        bank_pairs(ledger)
        .where(F.col("n") >= min_rows)
        .select(
            "from_bank",
            "to_bank",
            F.col("n").alias("n_total"),
            F.col("flagged").alias("n_laundering"),
            ratio(F.col("flagged"), F.col("n")).alias("laundering_rate"),
        )
        .orderBy(F.col("n_total").desc(), "from_bank", "to_bank")
    )


def scheme_visibility(ledger: DataFrame, patterns: DataFrame, k: int = 20) -> DataFrame:
    """b4: edges of each scheme seen by its best single bank, by a top-``k`` consortium with
    one end inside (loose), and with both ends inside (strict)."""
    # Two integer columns of the ledger are read; the broadcast result has at most k rows.
    volume = bank_profile(ledger, flags=False).select("bank", _total().alias("volume"))
    top = F.broadcast(top_banks(volume, k).select("bank", F.lit(1).alias("member")))
    members_from = top.select(F.col("bank").alias("from_bank"), F.col("member").alias("mf"))
    members_to = top.select(F.col("bank").alias("to_bank"), F.col("member").alias("mt"))
    inside = F.coalesce("mf", F.lit(0)) + F.coalesce("mt", F.lit(0))
    sender = F.struct(
        F.col("from_bank").alias("bank"),
        F.lit(1).alias("edge"),
        (inside >= 1).cast("int").alias("loose"),
        (inside == 2).cast("int").alias("strict"),
    )
    receiver = F.struct(
        F.col("to_bank").alias("bank"),
        F.lit(0).alias("edge"),
        F.lit(0).alias("loose"),
        F.lit(0).alias("strict"),
    )
    # An intra-bank edge is seen once, so it has one end only.
    ends = F.when(F.col("from_bank") == F.col("to_bank"), F.array(sender)).otherwise(
        F.array(sender, receiver)
    )
    per_bank = (
        patterns.join(members_from, "from_bank", "left")
        .join(members_to, "to_bank", "left")
        .select("pattern_group", "pattern_type", F.inline(ends))
        .groupBy("pattern_group", "bank")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            F.max("pattern_type").alias("pattern_type"),
            F.sum("edge").alias("edges"),
            F.sum("loose").alias("loose"),
            F.sum("strict").alias("strict"),
        )
    )
    return per_bank.groupBy("pattern_group").agg(
        F.max("pattern_type").alias("pattern_type"),
        F.sum("edges").alias("n_edges_total"),
        F.max("seen").alias("isolated_visible_edges"),
        F.sum("loose").alias("loose_consortium_edges"),
        F.sum("strict").alias("strict_consortium_edges"),
    )


def consortium_histogram(ledger: DataFrame) -> DataFrame:
    """b5: rows first covered when the ``k`` largest banks join, per coverage rule and label."""
    pairs = materialise(bank_pairs(ledger))
    ranks = ranked_banks(bank_volume(pairs)).select("bank", "rnk")
    senders = ranks.select(F.col("bank").alias("from_bank"), F.col("rnk").alias("rf"))
    receivers = ranks.select(F.col("bank").alias("to_bank"), F.col("rnk").alias("rt"))
    # Every bank of a corridor has a rank, so least/greatest never meet a NULL here.
    loose, strict = F.least("rf", "rt"), F.greatest("rf", "rt")
    clean, flagged = F.col("n") - F.col("flagged"), F.col("flagged")

    def cell(rule: str, label: int, k, rows):
        return F.struct(
            F.lit(rule).alias("coverage_type"),
            F.lit(label).alias("is_laundering"),
            k.alias("k"),
            rows.alias("rows"),
        )

    cells = F.array(
        cell("loose", 0, loose, clean),
        cell("loose", 1, loose, flagged),
        cell("strict", 0, strict, clean),
        cell("strict", 1, strict, flagged),
    )
    return (
        pairs.join(senders, "from_bank")
        .join(receivers, "to_bank")
        .select(F.inline(cells))
        .where(F.col("rows") > 0)
        .groupBy("coverage_type", "is_laundering", "k")
        .agg(F.sum("rows").alias("n_at_k"))
    )
