"""Feature table: row features, trailing windows, bank priors, temporal splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.clock import DAY_SECONDS, epoch_seconds, is_weekend
from ledgerlens.functions.draw import drawn
from ledgerlens.functions.labels import currency_bucket
from ledgerlens.operators.ordering import approximate_time_quantile, time_quantile
from ledgerlens.operators.trailing import RECEIVER, SENDER, TrailingSide, add_trailing
from ledgerlens.plans.quality import require_rows
from ledgerlens.session import materialise

# Split point and prior strength of the published method.
TRAIN_FRACTION = 0.80
CALIBRATION_FRACTION = 0.10
PRIOR_STRENGTH = 20

SENDER_PRIOR = "from_bank_laundering_rate_prior"
RECEIVER_PRIOR = "to_bank_laundering_rate_prior"

ROW_FEATURES = [
    "log_amount",
    "log10_amount_bucket",
    "currency_mismatch",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
]


def add_row_features(ledger: DataFrame, clamp_bucket: bool = False) -> DataFrame:
    """features of a row by itself; no shuffle.

    ``clamp_bucket`` holds the amount bucket at 0 below 0.1, where the formula goes negative.
    """
    amount = F.col("amount_paid").cast("double")
    decade = F.floor(F.log10(amount)).cast("int") + F.lit(1)
    decade = F.greatest(decade, F.lit(0)) if clamp_bucket else decade
    return ledger.withColumns(
        {
            "log_amount": F.log1p(amount),
            "log10_amount_bucket": F.when(amount <= 0, F.lit(0)).otherwise(
                F.least(decade, F.lit(10))
            ),
            "currency_mismatch": (
                F.col("payment_currency") != F.col("receiving_currency")
            ).cast("int"),
            "hour_of_day": F.hour("ts"),
            "day_of_week": F.dayofweek("ts"),
            "is_weekend": is_weekend(F.col("ts")),
            "ts_unix": epoch_seconds(F.col("ts")),
            "payment_currency_bucket": currency_bucket(F.col("payment_currency")),
            "receiving_currency_bucket": currency_bucket(F.col("receiving_currency")),
        }
    )


def build_features(
    ledger: DataFrame, sides: tuple[TrailingSide, ...] = (SENDER, RECEIVER)
) -> DataFrame:
    """the ledger with row features and the trailing features of the sides asked for.

    ``is_laundering`` becomes ``label``. Nothing is computed while the plan is built.
    """
    columns = add_row_features(ledger).columns
    for side in sides:
        keys = [side.account, "ts_unix"]
        columns = [*keys, *[name for name in columns if name not in keys], *side.columns()]
    # The rows meet the sides as narrow as they can be: what a row has by itself is computed behind
    # the joins.
    rows = ledger.withColumn("ts_unix", epoch_seconds(F.col("ts")))
    features = rows
    for side in sides:
        features = add_trailing(features, side, rows)
    return add_row_features(features).select(*columns).withColumnRenamed("is_laundering", "label")


def recent_rows(ledger: DataFrame, after: int) -> DataFrame:
    """The rows that trailing frames of rows later than second ``after`` can reach.

    Read before the windows, by day partitions: a split is taken before its features are built.
    """
    first = after - DAY_SECONDS
    day = F.to_date(F.timestamp_seconds(F.lit(first)))
    return ledger.where((F.col("txn_date") >= day) & (epoch_seconds(F.col("ts")) > first))


def first_days(ledger: DataFrame, start: str, days: int) -> DataFrame:
    """The first ``days`` days from ``start``; a range on the partition column."""
    begin = F.to_date(F.lit(start))
    return ledger.where(
        (F.col("txn_date") >= begin) & (F.col("txn_date") < F.date_add(begin, days))
    )


def sample_rows(ledger: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample by a hash of the key, so it repeats under any partitioning."""
    return ledger.where(drawn("txn_id", fraction, seed))


def temporal_cutoff(
    frame: DataFrame, fraction: float = TRAIN_FRACTION, exact: bool = True
) -> int:
    """the second up to which a share ``fraction`` of the rows lies."""
    find = time_quantile if exact else approximate_time_quantile
    cutoff = find(frame, "ts_unix", fraction)
    if cutoff is None:
        raise ValueError("cannot split an empty table by time")
    return cutoff


def temporal_split(frame: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cutoff, and rows after it."""
    return frame.where(F.col("ts_unix") <= cutoff), frame.where(F.col("ts_unix") > cutoff)


@dataclass
class BankPriors:
    """Smoothed flagged share per bank, both ends, and the overall share."""

    senders: DataFrame
    receivers: DataFrame
    overall: float


def bank_counts(train: DataFrame) -> DataFrame:
    """side, bank, rows and flagged rows, both sides from one scan; computed once."""
    sides = F.array(
        *[
            F.struct(F.lit(name).alias("side"), F.col(name).alias("bank"), "label")
            for name in ("from_bank", "to_bank")
        ]
    )
    return materialise(
        train.select(F.inline(sides))
        .groupBy("side", "bank")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("flagged"))
    )


def _overall(counts: DataFrame):
    """All rows and all flagged rows, from the counts of one side."""
    one_side = counts.where(F.col("side") == "from_bank")
    return one_side.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged"),
    ).first()


def bank_priors(train: DataFrame, strength: int = PRIOR_STRENGTH) -> BankPriors:
    """(flagged + strength x overall) / (rows + strength) per bank, from train rows only.

    The train rows are scanned once; both sides and the overall share come from the counts.
    """
    counts = bank_counts(train)
    row = _overall(counts)
    overall = float(row["flagged"]) / row["rows"] if row["rows"] else 0.0

    def prior(bank: str, name: str) -> DataFrame:
        smoothed = (F.col("flagged") + F.lit(strength * overall)) / (
            F.col("rows") + F.lit(strength)
        )
        return counts.where(F.col("side") == bank).select(
            F.col("bank").alias(bank), smoothed.alias(name)
        )

    return BankPriors(
        prior("from_bank", SENDER_PRIOR), prior("to_bank", RECEIVER_PRIOR), overall
    )


def join_priors(frame: DataFrame, priors: BankPriors) -> DataFrame:
    """attach both priors; a bank never seen in train gets the overall share.

    The join is chosen at run time by the measured size of the priors: broadcast, or by shuffle
    with hot banks split.
    """
    return (
        frame.join(priors.senders, "from_bank", "left")
        .join(priors.receivers, "to_bank", "left")
        .fillna(priors.overall, [SENDER_PRIOR, RECEIVER_PRIOR])
    )


def left_out_priors(train: DataFrame, strength: int = PRIOR_STRENGTH) -> DataFrame:
    """F5 without a row's own label: both priors of every train row from all other train rows.

    (flagged of the bank without this row + strength x overall without it) / (other rows of the
    bank + strength). The totals per bank are the only thing that is shuffled; a bank whose only
    row this is gets the overall share of the others.
    """
    counts = bank_counts(train)
    total = _overall(counts)
    others = F.lit(total["rows"] - 1)
    own = F.col("label")
    overall = F.coalesce((F.lit(total["flagged"]) - own) / F.nullif(others, F.lit(0)), F.lit(0.0))
    rows = train
    for bank, name in (("from_bank", SENDER_PRIOR), ("to_bank", RECEIVER_PRIOR)):
        side = counts.where(F.col("side") == bank).select(
            F.col("bank").alias(bank), F.col("rows").alias("_rows"), F.col("flagged").alias("_flagged")
        )
        smoothed = (F.col("_flagged") - own + F.lit(strength) * overall) / (
            F.col("_rows") - 1 + F.lit(strength)
        )
        rows = rows.join(side, bank).withColumn(name, smoothed).drop("_rows", "_flagged")
    return rows


def riskiest_banks(priors: BankPriors, k: int = 5) -> DataFrame:
    """The sending banks with the highest smoothed share."""
    return priors.senders.orderBy(F.col(SENDER_PRIOR).desc(), "from_bank").limit(k)


def write_features(features: DataFrame, path: str) -> DataFrame:
    """Materialise the window plan once as Parquet and return the table read back."""
    features.write.mode("overwrite").option("compression", "snappy").parquet(path)
    stored = features.sparkSession.read.parquet(path)
    require_rows(stored, "feature table")
    return stored
