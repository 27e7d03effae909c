"""Rule alerts on the feature table and their confusion figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rates import f1_score, ratio_or_zero

# Rule names as they stand in the published result tables.
STRUCTURING = "r1_structuring"
VELOCITY = "r2_velocity"
CROSS_BANK = "r5_cross_bank"
COMBINED = "rule_alert"
RULES = [STRUCTURING, VELOCITY, CROSS_BANK, COMBINED]
RULE_MODEL = "rule_baseline_R1_R2_R5"

#: Trailing features that the rules read, of both ends of a transfer.
RULE_FEATURES = [
    "out_count_24h", "out_sum_24h", "out_max_24h", "out_unique_banks_24h", "out_count_1h",
    "out_sum_1h", "in_count_24h", "in_sum_24h",
]

#: Those that ``velocity_same_account`` reads.
VELOCITY_FEATURES = ["out_count_1h", "out_sum_1h", "in_count_24h", "in_sum_24h"]


@dataclass(frozen=True)
class RuleThresholds:
    # Regulatory defaults of the published rules.
    structuring_min_rows: int = 5
    structuring_max_amount: float = 10000.0
    structuring_min_total: float = 30000.0
    velocity_min_in: int = 3
    velocity_min_out: int = 3
    velocity_max_residual: float = 0.10
    cross_bank_min_banks: int = 5
    cross_bank_min_rows: int = 10


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def apply_rules(features: DataFrame, limits: RuleThresholds = RuleThresholds()) -> DataFrame:
    """One 0/1 column per rule and their disjunction ``rule_alert``."""
    structuring = (
        (F.col("out_count_24h") >= limits.structuring_min_rows)
        & (_number("out_max_24h") < limits.structuring_max_amount)
        & (_number("out_sum_24h") > limits.structuring_min_total)
    )
    # Inflow of the receiver against outflow of the sender, as the published rule has it.
    residual = F.abs(_number("in_sum_24h") - _number("out_sum_1h")) / F.greatest(
        _number("in_sum_24h"), F.lit(1.0)
    )
    velocity = (
        (F.col("in_count_24h") >= limits.velocity_min_in)
        & (F.col("out_count_1h") >= limits.velocity_min_out)
        & (residual < limits.velocity_max_residual)
    )
    cross_bank = (F.col("out_unique_banks_24h") >= limits.cross_bank_min_banks) & (
        F.col("out_count_24h") >= limits.cross_bank_min_rows
    )
    return features.withColumns(
        {
            STRUCTURING: structuring.cast("int"),
            VELOCITY: velocity.cast("int"),
            CROSS_BANK: cross_bank.cast("int"),
        }
    ).withColumn(COMBINED, F.greatest(STRUCTURING, VELOCITY, CROSS_BANK))


def velocity_same_account(
    features: DataFrame, limits: RuleThresholds = RuleThresholds(), name: str = "r2_same_account"
) -> DataFrame:
    """X2 over one account: the sender's own inflow of 24 hours against its outflow of one hour.

    ``features`` carries the sender's outflow and, under the names of the receiving side, what
    the sending account itself took in (``operators.trailing.add_counterpart``).
    """
    inflow, outflow = _number("in_sum_24h"), _number("out_sum_1h")
    residual = F.abs(inflow - outflow) / F.greatest(inflow, F.lit(1.0))
    passed_on = (
        (F.col("in_count_24h") >= limits.velocity_min_in)
        & (F.col("out_count_1h") >= limits.velocity_min_out)
        & (residual < limits.velocity_max_residual)
    )
    return features.withColumn(name, passed_on.cast("int"))


def confusion_rows(frame: DataFrame, predictions: dict[str, str], label: str = "label") -> DataFrame:
    """name, tp, fp, fn, tn, precision, recall, f1, alert_volume for several 0/1 columns.

    ``predictions`` maps the reported name to the column. All columns are counted in one scan
    and one global aggregation.
    """

    def cell(column: str, predicted: int, actual: int) -> Column:
        hit = (F.col(column) == predicted) & (F.col(label) == actual)
        return F.count_if(hit)

    cells = {"tp": (1, 1), "fp": (1, 0), "fn": (0, 1), "tn": (0, 0)}
    counts = frame.agg(
        *[
            cell(column, *key).alias(f"_{i}_{name}")
            for i, column in enumerate(predictions.values())
            for name, key in cells.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(reported).alias("name"),
            *[F.col(f"_{i}_{name}").alias(name) for name in cells],
        )
        for i, reported in enumerate(predictions)
    ]
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumns(
            {
                "precision": ratio_or_zero(tp, tp + fp),
                "recall": ratio_or_zero(tp, tp + fn),
                "alert_volume": tp + fp,
            }
        )
        .withColumn("f1", f1_score(F.col("precision"), F.col("recall")))
        .select(
            "name", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "alert_volume"
        )
    )


def rule_metrics(scored: DataFrame) -> DataFrame:
    """Confusion figures of every rule and of their disjunction."""
    return confusion_rows(scored, {rule: rule for rule in RULES}).withColumnRenamed(
        "name", "rule"
    )


def rule_headline(scored: DataFrame) -> DataFrame:
    """The combined rule as one evaluation row; it has no curve, so pr_auc is NaN."""
    return confusion_rows(scored, {RULE_MODEL: COMBINED}).select(
        F.col("name").alias("model"),
        "precision",
        "recall",
        "f1",
        F.lit(float("nan")).alias("pr_auc"),
        "alert_volume",
    )
