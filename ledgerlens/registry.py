"""The named queries: each is a function of (spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.operators.components import account_graph, connected_components
from ledgerlens.operators.encoders import SinCosEncoder
from ledgerlens.operators.trailing import RECEIVER, SENDER, add_counterpart
from ledgerlens.plans import (
    activity,
    evaluation,
    features,
    models,
    quality,
    rollups,
    rules,
    scoring,
    sketches,
)
from ledgerlens.plans.catalogue import ACCOUNTS, LEDGER, REPORTS, SCHEMES
from ledgerlens.session import pin_session, shared_folder, store
from ledgerlens.sources import catalog, derived, files, pattern_text, warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _query(plan, *tables: str, **parameters) -> Query:
    """Bind a plan to the derived tables it reads."""
    loaders = [getattr(derived, table) for table in tables]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_session(spark)
        return plan(*[load(spark, sf_dir) for load in loaders], **parameters)

    return run


#: Corridor floor for the derived ledger (1,000 for a full-size one).
MIN_CORRIDOR_ROWS = 50


def report_queries() -> dict[str, Query]:
    parameters = {"q20": {"min_rows": MIN_CORRIDOR_ROWS}}
    return {
        name: _query(report.plan, *report.tables, **parameters.get(name, {}))
        for name, report in REPORTS.items()
    }


def _chart(report: str, chart, **parameters) -> Query:
    """A chart table computed from a report."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return chart(report_queries()[report](spark, sf_dir), **parameters)

    return run


def chart_queries() -> dict[str, Query]:
    return {
        "r1_format_share": _chart("q2", rollups.format_share),
        "r2_scope_share": _chart("q4", rollups.share_within_class, scope="scope"),
        "r2_currency_scope_share": _chart(
            "q13", rollups.share_within_class, scope="currency_scope"
        ),
        "r3_canonical_sizes": _chart("q6", rollups.canonical_sizes),
        "r4_busiest_receivers": _chart("q8", rollups.busiest_banks, by="in_transactions"),
        "r4_busiest_senders": _chart("q8", rollups.busiest_banks, by="out_transactions"),
        "r5_bank_spread_summary": _chart("q9", rollups.bank_spread_summary),
        "r6_amount_shape": _chart("q11", rollups.amount_shape),
        "r7_weekday_grid": _chart("q12", rollups.weekday_grid),
        "r8_duration_boxes": _chart("q14", rollups.duration_boxes),
        "r9_degree_ccdf": _chart("q15", rollups.degree_ccdf),
        "r10_component_buckets": _chart("q16", rollups.ordered_component_buckets),
        "r11_gap_density": _chart("q17", rollups.class_density, bin_column="decade"),
        "r11_structuring_density": _chart("b1", rollups.class_density, bin_column="bin_lo"),
        "r11_lifetime_density": _chart(
            "b15",
            rollups.class_density,
            bin_column="lifetime_bucket",
            label="ever_laundering",
            amount="n_accounts",
            all_bins=7,
        ),
        "r11_hour_density": _chart(
            "b16", rollups.class_density, bin_column="hour_of_day", all_bins=24
        ),
        "r12_bank_spread_grid": _chart("q18", rollups.bank_spread_grid),
        "r13_currency_grid": _chart("q19", rollups.currency_grid),
        "r14_corridors_by_volume": _chart("q20", rollups.top_corridors, by="n_total"),
        "r14_corridors_by_rate": _chart("q20", rollups.top_corridors, by="laundering_rate"),
        "r15_visibility_by_type": _chart("b4", rollups.visibility_by_type),
        "r16_coverage_curve": _chart("b5", rollups.coverage_curve),
        "r16_coverage_at": _chart("b5", rollups.coverage_at),
        "r17_cross_bank_by_type": _chart("b6", rollups.cross_bank_by_type),
        "r18_value_by_type": _query(rollups.value_by_canonical_type, SCHEMES),
        "r19_scatter_accounts": _chart("q5", rollups.scatter_accounts, share=0.4),
        "r20_bank_matrix_log": _chart(
            "q7", rollups.log_matrix, source="from_bank", target="to_bank"
        ),
        "r20_rank_matrix_log": _chart(
            "q7b", rollups.log_matrix, source="from_rank", target="to_rank"
        ),
        "r22_daily_rate_percent": _chart("q1", rollups.daily_rate_percent),
        "r22_bank_rank_size": _query(rollups.bank_rank_size, LEDGER),
    }


# The derived ledger has at most 11 rows per sender and day, so the alert limits and the
# alert budget of the checks are set to where they separate its rows.
RULE_LIMITS = rules.RuleThresholds(
    structuring_min_rows=3,
    structuring_max_amount=1000000.0,
    structuring_min_total=30000.0,
    velocity_min_in=2,
    velocity_min_out=1,
    velocity_max_residual=0.5,
    cross_bank_min_banks=4,
    cross_bank_min_rows=5,
)
ALERTS_PER_DAY = 60
PINNED = 0.55
SCORE_MODEL = "activity_score"


def _numbers(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Row key and feature columns; decimals as doubles for the comparison."""
    kinds = dict(frame.dtypes)
    return frame.select(
        "txn_id",
        *[
            F.col(name).cast("double").alias(name)
            if kinds[name].startswith("decimal")
            else F.col(name)
            for name in columns
        ],
    )


def row_feature_table(ledger: DataFrame) -> DataFrame:
    extra = ["ts_unix", "payment_currency_bucket", "receiving_currency_bucket"]
    table = _numbers(features.add_row_features(ledger), features.ROW_FEATURES + extra)
    return table.withColumn("log_amount", F.round("log_amount", 6))


def sender_feature_table(ledger: DataFrame) -> DataFrame:
    return _numbers(features.build_features(ledger, (SENDER,)), SENDER.columns())


def receiver_feature_table(ledger: DataFrame) -> DataFrame:
    return _numbers(features.build_features(ledger, (RECEIVER,)), RECEIVER.columns())


def _cutoff(ledger: DataFrame) -> int:
    """The temporal cutoff needs the timestamps only, not the feature windows."""
    return features.temporal_cutoff(features.add_row_features(ledger).select("ts_unix"))


def split_table(ledger: DataFrame) -> DataFrame:
    """rows, flagged rows and time range of both sides of the split, and the cutoff."""
    rows = features.add_row_features(ledger)
    cutoff = _cutoff(ledger)
    side = F.when(F.col("ts_unix") <= cutoff, F.lit("train")).otherwise(F.lit("test"))
    return rows.groupBy(side.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_laundering").alias("positives"),
        F.min("ts_unix").alias("first_second"),
        F.max("ts_unix").alias("last_second"),
        F.from_unixtime(F.lit(cutoff)).alias("cutoff_time"),
    )


def _train_priors(ledger: DataFrame) -> tuple[DataFrame, features.BankPriors]:
    """All rows with their label, and the priors learnt from the train rows."""
    rows = features.add_row_features(ledger).withColumnRenamed("is_laundering", "label")
    train, _ = features.temporal_split(rows, _cutoff(ledger))
    return rows, features.bank_priors(train)


def prior_table(ledger: DataFrame) -> DataFrame:
    """F5 + F6: both priors on every row, learnt from the train rows."""
    rows, priors = _train_priors(ledger)
    names = [features.SENDER_PRIOR, features.RECEIVER_PRIOR]
    return features.join_priors(rows, priors).select(
        "txn_id", *[F.round(name, 9).alias(name) for name in names]
    )


def riskiest_bank_table(ledger: DataFrame) -> DataFrame:
    top = features.riskiest_banks(_train_priors(ledger)[1])
    return top.withColumn(features.SENDER_PRIOR, F.round(features.SENDER_PRIOR, 9))


def _alerts(ledger: DataFrame, limits: rules.RuleThresholds = RULE_LIMITS) -> DataFrame:
    sides = tuple(side.only(rules.RULE_FEATURES) for side in (SENDER, RECEIVER))
    return rules.apply_rules(features.build_features(ledger, sides), limits)


def rule_flag_table(
    ledger: DataFrame, limits: rules.RuleThresholds = RULE_LIMITS
) -> DataFrame:
    return _alerts(ledger, limits).select("txn_id", *rules.RULES)


def _test_alerts(
    ledger: DataFrame, limits: rules.RuleThresholds = RULE_LIMITS
) -> DataFrame:
    cutoff = _cutoff(ledger)
    recent = features.recent_rows(ledger, cutoff)
    return features.temporal_split(_alerts(recent, limits), cutoff)[1]


def rule_metric_table(
    ledger: DataFrame, limits: rules.RuleThresholds = RULE_LIMITS
) -> DataFrame:
    return rules.rule_metrics(_test_alerts(ledger, limits))


def rule_headline_table(ledger: DataFrame) -> DataFrame:
    """The combined rule as an evaluation row, without a curve."""
    return rules.rule_headline(_test_alerts(ledger))


def rule_value_table(ledger: DataFrame) -> DataFrame:
    return evaluation.rule_value_rows(_test_alerts(ledger))


def _scored(ledger: DataFrame) -> DataFrame:
    """A score that SQL can repeat: recent activity of the sender, squeezed into 0..1."""
    activity_level = F.col("out_count_24h").cast("double")
    scored = features.build_features(ledger, (SENDER.only(["out_count_24h"]),)).withColumn(
        "proba_positive", activity_level / (activity_level + F.lit(3.0))
    )
    return scored.withColumn("prediction", (F.col("proba_positive") >= PINNED).cast("int"))


def _scored_test(ledger: DataFrame) -> DataFrame:
    cutoff = _cutoff(ledger)
    return features.temporal_split(_scored(features.recent_rows(ledger, cutoff)), cutoff)[1]


def threshold_sweep_table(ledger: DataFrame) -> DataFrame:
    return evaluation.threshold_sweep(
        _scored_test(ledger), evaluation.CALIBRATION_GRID, SCORE_MODEL
    )


def value_sweep_table(ledger: DataFrame) -> DataFrame:
    return evaluation.value_sweep(_scored_test(ledger), evaluation.CALIBRATION_GRID, SCORE_MODEL)


def pattern_recall_table(ledger: DataFrame, schemes: DataFrame) -> DataFrame:
    return evaluation.pattern_recall(_scored_test(ledger), schemes, SCORE_MODEL)


def weekend_recall_table(ledger: DataFrame) -> DataFrame:
    return evaluation.weekend_recall(_scored_test(ledger), SCORE_MODEL)


def pinned_threshold_table(ledger: DataFrame) -> DataFrame:
    """M7: calibration on the last tenth of the train rows."""
    seconds = features.add_row_features(ledger).select("ts_unix")
    cutoff = features.temporal_cutoff(seconds)
    start = features.temporal_cutoff(
        features.temporal_split(seconds, cutoff)[0], 1.0 - features.CALIBRATION_FRACTION
    )
    scored = _scored(features.recent_rows(ledger, start))
    train, _ = features.temporal_split(scored, cutoff)
    return evaluation.pin_threshold(
        features.temporal_split(train, start)[1], SCORE_MODEL, alerts_per_day=ALERTS_PER_DAY
    )


def precision_recall_table(ledger: DataFrame) -> DataFrame:
    return evaluation.precision_recall_points(threshold_sweep_table(ledger))


def value_recall_table(ledger: DataFrame) -> DataFrame:
    return evaluation.value_recall_points(value_sweep_table(ledger))


def feature_queries() -> dict[str, Query]:
    return {
        "f1_row_features": _query(row_feature_table, LEDGER),
        "f2_sender_windows": _query(sender_feature_table, LEDGER),
        "f4_receiver_windows": _query(receiver_feature_table, LEDGER),
        "f5_bank_priors": _query(prior_table, LEDGER),
        "f7_temporal_split": _query(split_table, LEDGER),
        "o8_riskiest_banks": _query(riskiest_bank_table, LEDGER),
        "x4_rule_flags": _query(rule_flag_table, LEDGER),
        "x5_rule_metrics": _query(rule_metric_table, LEDGER),
        "x5_rule_headline": _query(rule_headline_table, LEDGER),
        "m7_pinned_threshold": _query(pinned_threshold_table, LEDGER),
        "e3_threshold_sweep": _query(threshold_sweep_table, LEDGER),
        "e4_value_sweep": _query(value_sweep_table, LEDGER),
        "e5_rule_value": _query(rule_value_table, LEDGER),
        "e6_pattern_recall": _query(pattern_recall_table, LEDGER, SCHEMES),
        "e6_duplicate_keys": _query(evaluation.duplicate_pattern_keys, SCHEMES),
        "e7_weekend_recall": _query(weekend_recall_table, LEDGER),
        "r21_precision_recall": _query(precision_recall_table, LEDGER),
        "r21_value_recall": _query(value_recall_table, LEDGER),
    }


def table_counts(ledger: DataFrame, schemes: DataFrame, accounts: DataFrame) -> DataFrame:
    return quality.row_counts(
        {"transactions": ledger, "laundering_patterns": schemes, "accounts": accounts}
    )


def ledger_sample(ledger: DataFrame) -> DataFrame:
    sample = quality.sample_rows_by_key(ledger, "txn_id")
    return sample.select(
        "txn_id", "from_bank", "from_account", "to_bank", "to_account",
        F.col("amount_paid").cast("double").alias("amount_paid"),
        "payment_currency", "payment_format", "is_laundering", "txn_date",
    )


def bucket_cardinalities(ledger: DataFrame) -> DataFrame:
    return quality.cardinalities(
        features.add_row_features(ledger),
        ["payment_format", "payment_currency_bucket", "receiving_currency_bucket"],
    )


def active_window_days(ledger: DataFrame, until: str) -> DataFrame:
    return activity.daily_rate(ledger.where(F.col("txn_date") <= F.to_date(F.lit(until))))


def quality_queries() -> dict[str, Query]:
    return {
        "d1_row_counts": _query(table_counts, LEDGER, SCHEMES, ACCOUNTS),
        "d3_ledger_sample": _query(ledger_sample, LEDGER),
        "d4_sanity_checks": _query(quality.sanity_checks, LEDGER, SCHEMES),
        "d5_class_balance": _query(quality.class_balance, LEDGER, label="is_laundering"),
        "d6_cardinalities": _query(bucket_cardinalities, LEDGER),
        "s7_active_window": _query(active_window_days, LEDGER, until="2024-01-28"),
    }


SECOND = "yyyy/MM/dd HH:mm:ss"


def numbered_load_table(ledger: DataFrame) -> DataFrame:
    """S2 + S4 + S5: the ledger through CSV files, checked and numbered in file order."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "transfers")
    derived.write_transfer_csv(ledger, folder, SECOND)
    loaded, _ = warehouse.load_transfers(files.read_transfers(spark, folder, SECOND))
    return loaded.select(
        "txn_id", "ts", "from_bank", "from_account", "to_bank", "to_account",
        F.col("amount_paid").cast("double").alias("amount_paid"), "payment_currency",
        "payment_format", "is_laundering",
    )


def scheme_text_table(schemes: DataFrame) -> DataFrame:
    """The labelled transfers through attempt-block text files and back."""
    spark = schemes.sparkSession
    folder = shared_folder(spark, "schemes")
    derived.write_scheme_text(schemes, folder, SECOND)
    return pattern_text.parse_scheme_text(spark, folder, blocks_span_files=True).rows


MSK_MILLIS = 10_800_000


def _as_raw(frame: DataFrame) -> DataFrame:
    """Rows as an export with zone-shifted epoch millis and textual amounts has them."""
    return frame.withColumns(
        {
            "timestamp": F.unix_millis("ts") - F.lit(MSK_MILLIS),
            "amount_received": F.col("amount_received").cast("string"),
            "amount_paid": F.col("amount_paid").cast("string"),
        }
    ).drop("ts", "txn_date")


def warehouse_load_table(ledger: DataFrame) -> DataFrame:
    """Shifted millis and textual amounts to typed rows of the active window."""
    loaded = warehouse.warehouse_transactions(
        _as_raw(ledger), until="2024-01-28", shift_millis=MSK_MILLIS
    )
    return loaded.withColumns(
        {name: F.col(name).cast("double") for name in ("amount_received", "amount_paid")}
    )


def pattern_load_table(schemes: DataFrame) -> DataFrame:
    """The same for labelled transfers, all of them."""
    loaded = warehouse.warehouse_patterns(_as_raw(schemes), shift_millis=MSK_MILLIS)
    return loaded.withColumns(
        {name: F.col(name).cast("double") for name in ("amount_received", "amount_paid")}
    )


def first_days_table(ledger: DataFrame) -> DataFrame:
    """The first week of the ledger."""
    return activity.daily_rate(features.first_days(ledger, "2024-01-01", 7))


def _doubles(frame: DataFrame) -> DataFrame:
    """Decimals as doubles for the comparison."""
    return frame.withColumns(
        {
            name: F.col(name).cast("double")
            for name, kind in frame.dtypes
            if kind.startswith("decimal")
        }
    )


def hash_sample_table(ledger: DataFrame) -> DataFrame:
    """Keys of a quarter of the ledger, drawn by key."""
    return features.sample_rows(ledger, 0.25).select("txn_id")


def quarantine_table(ledger: DataFrame) -> DataFrame:
    """Rows that break a constraint, with the reason; the ledger is damaged by rule first."""
    damaged = ledger.drop("txn_date").withColumns(
        {
            "from_account": F.when(F.col("txn_id") % 10 != 0, F.col("from_account")),
            "is_laundering": F.when(F.col("txn_id") % 7 == 0, 2).otherwise(F.col("is_laundering")),
        }
    )
    return quality.split_valid(damaged)[1].select("txn_id", "reason")


def scheme_reject_table(schemes: DataFrame) -> DataFrame:
    """Lines of attempt blocks with a field too many, through text files and back."""
    spark = schemes.sparkSession
    folder = shared_folder(spark, "schemes")
    derived.write_scheme_text(
        schemes.withColumn(
            "payment_format",
            F.when(F.col("payment_format") == "Wire", F.lit("Wire,extra")).otherwise(
                F.col("payment_format")
            ),
        ),
        folder,
        SECOND,
    )
    return pattern_text.parse_scheme_text(spark, folder, blocks_span_files=True).rejects


def accounts_csv_table(accounts: DataFrame) -> DataFrame:
    """S1 + S14: the accounts through header CSV files."""
    folder = shared_folder(accounts.sparkSession, "accounts")
    files.write_csv(accounts.select(*schema.ACCOUNTS.names), folder)
    return files.read_accounts(accounts.sparkSession, folder)


def pattern_csv_table(schemes: DataFrame) -> DataFrame:
    """S3: labelled transfers through CSV files."""
    spark = schemes.sparkSession
    folder = shared_folder(spark, "pattern-rows")
    rows = schemes.select(*schema.PATTERN_ROW.names).withColumn(
        "ts", F.date_format("ts", SECOND)
    )
    files.write_csv(rows, folder)
    return _doubles(files.read_pattern_rows(spark, folder, SECOND))


def day_files_table(ledger: DataFrame) -> DataFrame:
    """S7 + S11 + S12: the ledger as Parquet files by day, read back."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "days")
    warehouse.save_ledger_files(ledger, folder)
    return _doubles(files.read_parquet(spark, folder)).select("txn_id", "ts", "amount_paid", "txn_date")


def training_json_table(ledger: DataFrame) -> DataFrame:
    """Features and label as gzip JSON lines, counted and summed after reading."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "training-json")
    rows = ledger.select(
        F.array(F.col("txn_id"), F.col("from_bank").cast("bigint")).alias("features"),
        F.col("is_laundering").alias("label"),
    )
    files.write_training_json(rows, folder)
    back = spark.read.schema("features array<bigint>, label int").json(folder)
    return back.select(
        F.col("features")[0].alias("txn_id"), F.col("features")[1].alias("from_bank"), "label"
    )


def external_tables_table(ledger: DataFrame) -> DataFrame:
    """S16 + S18 + S19 + S20 + S23: a Parquet and a CSV table over files, joined by key."""
    spark = ledger.sparkSession
    tables = []
    for kind in ("parquet", "csv"):
        folder = shared_folder(spark, f"external-{kind}")
        rows = ledger.select("txn_id", "from_account", "is_laundering")
        table = "t_" + folder.rsplit("-", 1)[1]
        if kind == "parquet":
            files.write_parquet(rows, folder)
            catalog.register_parquet(spark, table, folder)
        else:
            files.write_csv(rows, folder)
            catalog.register_csv(spark, table, folder, rows.schema)
        tables.append(catalog.read_table(spark, table))
        catalog.drop_table(spark, table)
    return tables[0].join(
        tables[1].withColumnRenamed("from_account", "csv_account"), ["txn_id", "is_laundering"]
    )


def source_queries() -> dict[str, Query]:
    return {
        "s1_accounts_csv": _query(accounts_csv_table, ACCOUNTS),
        "s3_pattern_csv": _query(pattern_csv_table, SCHEMES),
        "s4_quarantine": _query(quarantine_table, LEDGER),
        "s6_rejects": _query(scheme_reject_table, SCHEMES),
        "s11_day_files": _query(day_files_table, LEDGER),
        "s13_training_json": _query(training_json_table, LEDGER),
        "s18_external_tables": _query(external_tables_table, LEDGER),
        "s27_hash_sample": _query(hash_sample_table, LEDGER),
        "s7_warehouse_load": _query(warehouse_load_table, LEDGER),
        "s8_pattern_load": _query(pattern_load_table, SCHEMES),
        "s27_first_days": _query(first_days_table, LEDGER),
        "s5_numbered_load": _query(numbered_load_table, LEDGER),
        "s6_scheme_text": _query(scheme_text_table, SCHEMES),
    }


def _encoded(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    table = features.build_features(ledger)
    table = store(table.select(*[name for name in table.columns if name in models.MODEL_COLUMNS]))
    train, test = features.temporal_split(table, _cutoff(ledger))
    priors = features.bank_priors(train)
    _, train, test = models.encode(
        features.join_priors(train, priors), features.join_priors(test, priors)
    )
    return train, test


def _model_headline(candidate, ledger: DataFrame, schemes: DataFrame) -> DataFrame:
    """E1 for one model: train, pin on the calibration tail, report on the test rows."""
    train, test = _encoded(ledger)
    inner, calibration = models.calibration_split(train)
    trained = models.cross_validate(candidate, models.balance_classes(inner))
    return models.evaluate_model(
        trained, calibration, test, schemes, alerts_per_day=ALERTS_PER_DAY
    ).headline


def logistic_headline(ledger: DataFrame, schemes: DataFrame) -> DataFrame:
    return _model_headline(models.logistic_candidate(), ledger, schemes)


def trees_headline(ledger: DataFrame, schemes: DataFrame) -> DataFrame:
    return _model_headline(models.trees_candidate(), ledger, schemes)


def cyclic_table(ledger: DataFrame) -> DataFrame:
    """F8: sine and cosine of hour and weekday on every row."""
    rows = features.add_row_features(ledger)
    names = []
    for column, period in models.CYCLES.items():
        encoder = SinCosEncoder(inputCol=column, period=period)
        rows, names = encoder.transform(rows), names + encoder.outputColumns()
    return rows.select("txn_id", *[F.round(name, 9).alias(name) for name in names])


def calibration_table(ledger: DataFrame) -> DataFrame:
    """M1: rows and time range of the train rows kept for fitting and of the calibration tail."""
    rows = features.add_row_features(ledger).select("ts_unix")
    train, _ = features.temporal_split(rows, features.temporal_cutoff(rows))
    inner, tail = models.calibration_split(train)
    parts = [part.withColumn("part", F.lit(name)) for name, part in (("fit", inner), ("tail", tail))]
    return (
        parts[0]
        .unionByName(parts[1])
        .groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ts_unix").alias("first_second"),
            F.max("ts_unix").alias("last_second"),
        )
    )


def balanced_table(ledger: DataFrame) -> DataFrame:
    """M2: rows and weight per class after the draw, which hashes row keys."""
    rows = ledger.withColumnRenamed("is_laundering", "label").select("txn_id", "label")
    return (
        models.balance_classes(rows, negatives_per_positive=5)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))
    )


def component_table(ledger: DataFrame) -> DataFrame:
    """The component of every account."""
    return connected_components(*account_graph(ledger))


#: Whole-number and rounded row features that both models and SQL can repeat.
STATED_NUMERIC = ["log_amount", "log10_amount_bucket", "currency_mismatch", "hour_of_day", "is_weekend"]


def _stated_features(ledger: DataFrame) -> DataFrame:
    return features.add_row_features(ledger).withColumn("log_amount", F.round("log_amount", 6))


def scored_rows_table(ledger: DataFrame) -> DataFrame:
    """M9: every row scored by compiled models, as a projection of the scan."""
    rows = _stated_features(ledger)
    return rows.select(
        "txn_id",
        F.round(scoring.probability(scoring.STATED_LINEAR), 9).alias("linear_score"),
        F.round(scoring.probability(scoring.STATED_TREES), 9).alias("trees_score"),
        (scoring.margin(scoring.STATED_TREES) > 0).cast("int").alias("trees_prediction"),
    )


def pr_area_table(ledger: DataFrame) -> DataFrame:
    """The exact area under the curve of the activity score on the test rows."""
    return evaluation.area_under_pr(_scored_test(ledger)).withColumn("area", F.round("area", 9))


def _stated_index(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = _stated_features(ledger)
    train, test = features.temporal_split(rows, _cutoff(ledger))
    return store(models.category_index(train)), test


def category_index_table(ledger: DataFrame) -> DataFrame:
    """the index of every category, learnt from the train rows."""
    return _stated_index(ledger)[0]


def encoded_table(ledger: DataFrame) -> DataFrame:
    """the test rows in long form; rows of one currency miss a feature and are marked."""
    index, test = _stated_index(ledger)
    damaged = test.withColumn(
        "log_amount", F.when(F.col("payment_currency") != "Euro", F.col("log_amount"))
    )
    return models.encode_long(damaged, index, STATED_NUMERIC)


def fold_table(ledger: DataFrame) -> DataFrame:
    """M5: rows and classes of every fold after the classes are balanced."""
    rows = ledger.withColumnRenamed("is_laundering", "label").select("txn_id", "label")
    folded = models.with_folds(models.balance_classes(rows, negatives_per_positive=5))
    return folded.groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min("txn_id").alias("first_key"), F.max("txn_id").alias("last_key")
    )


def left_out_table(ledger: DataFrame) -> DataFrame:
    """the priors of every train row without its own label."""
    rows = features.add_row_features(ledger).withColumnRenamed("is_laundering", "label")
    train, _ = features.temporal_split(rows, _cutoff(ledger))
    names = [features.SENDER_PRIOR, features.RECEIVER_PRIOR]
    return features.left_out_priors(train).select(
        "txn_id", *[F.round(name, 9).alias(name) for name in names]
    )


def same_account_table(ledger: DataFrame) -> DataFrame:
    """X2 over one account: what the sender itself took in against what it sends on."""
    rows = features.add_row_features(ledger)
    sent = features.build_features(ledger, (SENDER.only(rules.VELOCITY_FEATURES),))
    both = add_counterpart(sent, RECEIVER.only(rules.VELOCITY_FEATURES), "from_account", rows)
    return rules.velocity_same_account(both, RULE_LIMITS).select(
        "txn_id", "in_count_24h", "out_count_1h", "r2_same_account"
    )


def distinct_sketch_table(ledger: DataFrame) -> DataFrame:
    """Sketches per day, stored, merged, and held against the exact counts."""
    names = ["from_account", "to_account", "from_bank"]
    daily = store(sketches.daily_sketches(ledger, names, []))
    checks = [sketches.distinct_check(ledger, daily, name) for name in names]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


def quantile_sketch_table(ledger: DataFrame) -> DataFrame:
    """The same for quantiles of time and of the amount in hundredths."""
    rows = features.add_row_features(ledger).withColumn(
        "hundredths", F.floor(F.col("amount_paid") * 100).cast("bigint")
    )
    daily = store(sketches.daily_sketches(rows, [], ["ts_unix", "hundredths"]))
    fractions = [0.25, 0.5, 0.8, 0.99]
    checks = [sketches.quantile_check(rows, daily, name, fractions) for name in ("ts_unix", "hundredths")]
    return checks[0].unionByName(checks[1])


def _stated_name(folder: str) -> str:
    return "t_" + folder.rsplit("-", 1)[1]


def bucketed_profiles(ledger: DataFrame) -> DataFrame:
    """Transfers of every bank against its profile, both bucketed by bank and joined."""
    spark = ledger.sparkSession
    profile = ledger.groupBy(F.col("to_bank").alias("bank")).agg(
        F.count(F.lit(1)).alias("received"), F.sum("is_laundering").alias("received_flagged")
    )
    tables = []
    sides = {"bank": profile, "from_bank": ledger.select("from_bank", "txn_id", "is_laundering")}
    for key, side in sides.items():
        folder = shared_folder(spark, f"bucketed-{key.replace('_', '')}")
        tables.append(warehouse.save_bucketed(side, _stated_name(folder), key, folder))
        catalog.drop_table(spark, _stated_name(folder))
    # Merged, not broadcast: the buckets already hold what belongs together.
    joined = tables[1].join(tables[0].hint("merge"), F.col("from_bank") == F.col("bank"))
    return joined.groupBy("from_bank").agg(
        F.count(F.lit(1)).alias("sent"),
        F.sum("is_laundering").alias("sent_flagged"),
        F.first("received").alias("received"),
        F.first("received_flagged").alias("received_flagged"),
    )


#: The day that is loaded again, with the rows of one parity only.
RELOADED = "2024-01-10"


def reloaded_day_table(ledger: DataFrame) -> DataFrame:
    """Rows and keys per day before and after one day is loaded again in part."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "reloaded")
    warehouse.save_ledger_files(ledger, folder)
    per_day = [F.count(F.lit(1)).alias("n"), F.sum("txn_id").alias("keys")]
    before = store(files.read_parquet(spark, folder).groupBy("txn_date").agg(*per_day))
    again = ledger.where((F.col("txn_date") == F.lit(RELOADED).cast("date")) & (F.col("txn_id") % 2 == 0))
    warehouse.reload_days(again, folder)
    after = files.read_parquet(spark, folder).groupBy("txn_date").agg(*per_day)
    return before.withColumnsRenamed({"n": "n_before", "keys": "keys_before"}).join(
        after, "txn_date", "left"
    )


def file_table(ledger: DataFrame) -> DataFrame:
    """Rows per day of the staged files, from the files' own metadata."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "probed")
    warehouse.save_ledger_files(ledger, folder)
    found = files.file_relation(spark.read.parquet(folder))
    day = F.to_date(F.regexp_extract("path", "txn_date=([0-9-]+)", 1))
    return found.groupBy(day.alias("txn_date")).agg(
        F.sum("rows").alias("n"), F.min(F.col("bytes") > 0).alias("all_filled")
    )


def schema_table(ledger: DataFrame) -> DataFrame:
    """D2 + S17: columns of a stored result table, with how many rows fill them."""
    spark = ledger.sparkSession
    folder = shared_folder(spark, "described")
    table = _stated_name(folder)
    files.write_parquet(
        ledger.drop("ts").withColumn("to_bank", F.when(F.col("to_bank") % 2 == 0, F.col("to_bank"))), folder
    )
    catalog.register_parquet(spark, table, folder)
    filled = store(catalog.filled_columns(spark, table))
    catalog.drop_table(spark, table)
    return filled


def mechanism_queries() -> dict[str, Query]:
    """Layouts, reloads, sketches and compiled models as checked results."""
    return {
        "m9_scored_rows": _query(scored_rows_table, LEDGER),
        "e2_area_under_pr": _query(pr_area_table, LEDGER),
        "f9_encoded": _query(encoded_table, LEDGER),
        "f10_index": _query(category_index_table, LEDGER),
        "m5_folds": _query(fold_table, LEDGER),
        "f5_left_out": _query(left_out_table, LEDGER),
        "x2_same_account": _query(same_account_table, LEDGER),
        "a8_sketch": _query(distinct_sketch_table, LEDGER),
        "a17_sketch": _query(quantile_sketch_table, LEDGER),
        "s9_bucketed": _query(bucketed_profiles, LEDGER),
        "s7_reload_day": _query(reloaded_day_table, LEDGER),
        "s24_files": _query(file_table, LEDGER),
        "d2_schema": _query(schema_table, LEDGER),
    }


def model_queries() -> dict[str, Query]:
    """Training has no SQL answer; grids, iterations and rows are those of the method."""
    return {
        "g2_components": _query(component_table, LEDGER),
        "f8_cyclic_encoding": _query(cyclic_table, LEDGER),
        "m1_calibration_split": _query(calibration_table, LEDGER),
        "m2_balanced_classes": _query(balanced_table, LEDGER),
        "e1_logistic_headline": _query(logistic_headline, LEDGER, SCHEMES),
        "e1_trees_headline": _query(trees_headline, LEDGER, SCHEMES),
    }


#: Reports that make sense on the larger ledger: its dates have no time of day, its senders
#: never receive, and its rows have no key.
VOLUME_REPORTS = ["q1", "q2", "q3", "q4", "q5", "q7", "q11", "q15", "q20", "b1", "b5", "b15"]


def volume_queries() -> dict[str, Query]:
    """The same reports on the ledger derived from the order tables."""
    parameters = {"q20": {"min_rows": MIN_CORRIDOR_ROWS}}
    return {
        f"v_{name}": _query(
            REPORTS[name].plan, "volume_transactions", **parameters.get(name, {})
        )
        for name in VOLUME_REPORTS
    }


#: Queries repeated on the harsher ledger, the rules with their published limits.
DENSE_QUERIES = [
    "f2_sender_windows", "f4_receiver_windows", "x4_rule_flags", "x5_rule_metrics",
    "q7b", "e6_pattern_recall", "e6_duplicate_keys",
]


def dense_queries() -> dict[str, Query]:
    ledger, schemes = "dense_transactions", "dense_laundering_patterns"
    published = rules.RuleThresholds()
    return {
        "h_f2_sender_windows": _query(sender_feature_table, ledger),
        "h_f4_receiver_windows": _query(receiver_feature_table, ledger),
        "h_x4_rule_flags": _query(rule_flag_table, ledger, limits=published),
        "h_x5_rule_metrics": _query(rule_metric_table, ledger, limits=published),
        "h_q7b": _query(REPORTS["q7b"].plan, ledger),
        "h_e6_pattern_recall": _query(pattern_recall_table, ledger, schemes),
        "h_e6_duplicate_keys": _query(evaluation.duplicate_pattern_keys, schemes),
    }


def all_queries() -> dict[str, Query]:
    return {
        **dense_queries(),
        **report_queries(),
        **chart_queries(),
        **feature_queries(),
        **quality_queries(),
        **source_queries(),
        **model_queries(),
        **mechanism_queries(),
        **volume_queries(),
    }
