"""The batch stages, in the order a full run takes them.

Every stage reads tables of a database and writes tables or files, so a stage can be repeated
by itself. ``folder`` arguments name storage that all executors reach.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans import evaluation, features, models, quality, rules
from ledgerlens.plans.catalogue import ACCOUNTS, LEDGER, REPORTS, SCHEMES
from ledgerlens.session import discard_staged, staged_count
from ledgerlens.sources import catalog, files, pattern_text, warehouse


@dataclass(frozen=True)
class RawPaths:
    transfers: str
    schemes: str
    accounts: str
    timestamp_format: str = files.RAW_TIMESTAMP
    #: The scheme files are parts of one text, in the order of their names.
    schemes_span_files: bool = False


def load(
    spark: SparkSession,
    raw: RawPaths,
    database: str,
    until: str | None = None,
    strict: bool = True,
) -> None:
    """Stage 1: raw files to warehouse tables. Schemes come as attempt-block text.

    Rows that break a constraint fail the job, or go to ``<ledger>_rejects`` if not ``strict``.
    """
    staged = staged_count()
    transfers, rejected = warehouse.load_transfers(
        files.read_transfers(spark, raw.transfers, raw.timestamp_format), strict
    )
    if rejected is not None:
        _save(rejected, f"{database}.{LEDGER}_rejects")
    warehouse.save_ledger(warehouse.with_date(transfers, until), f"{database}.{LEDGER}")
    parsed = pattern_text.parse_scheme_text(
        spark, raw.schemes, blocks_span_files=raw.schemes_span_files
    )
    # Lines that are no transfer are kept apart, with the reason, and counted by ``describe``.
    _save(parsed.rejects, f"{database}.{SCHEMES}_rejects")
    typed = pattern_text.typed_scheme_rows(parsed, raw.timestamp_format)
    quality.assert_valid(typed).write.mode("overwrite").format("parquet").saveAsTable(
        f"{database}.{SCHEMES}"
    )
    files.read_accounts(spark, raw.accounts).write.mode("overwrite").format(
        "parquet"
    ).saveAsTable(f"{database}.{ACCOUNTS}")
    discard_staged(staged)


def _save(frame: DataFrame, table: str) -> None:
    frame.write.mode("overwrite").format("parquet").saveAsTable(table)


def run_reports(
    spark: SparkSession,
    database: str,
    names: Iterable[str] | None = None,
    export_folder: str | None = None,
) -> list[str]:
    """Stage 2: result table per report, and a CSV export where a folder is given."""
    written = []
    for name in names or REPORTS:
        report = REPORTS[name]
        result = report.plan(*[spark.table(f"{database}.{table}") for table in report.tables])
        table = catalog.save_result(result, name, database)
        if export_folder:
            files.write_csv(spark.table(table), f"{export_folder}/{name}")
        written.append(table)
    return written


def describe(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Row counts, schemas, samples and checks of the base tables."""
    tables = {name: spark.table(f"{database}.{name}") for name in (LEDGER, SCHEMES, ACCOUNTS)}
    keys = {LEDGER: "txn_id", SCHEMES: "pattern_id", ACCOUNTS: "account_number"}
    return {
        "row_counts": quality.row_counts(tables),
        "sanity_checks": quality.sanity_checks(tables[LEDGER], tables[SCHEMES]),
        **{
            f"schema_{name}": catalog.describe_schema(spark, f"{database}.{name}")
            for name in tables
        },
        **{
            f"sample_{name}": quality.sample_rows_by_key(frame, keys[name])
            for name, frame in tables.items()
        },
    }


def build_features(spark: SparkSession, database: str, folder: str) -> None:
    """Stage 3a: feature table, encoded train and test rows, fitted encoding."""
    ledger = catalog.read_table(spark, f"{database}.{LEDGER}")
    quality.require_rows(ledger, LEDGER)
    staged = staged_count()
    location = f"{folder}/features"
    table = features.write_features(features.build_features(ledger), location)
    catalog.register_parquet(spark, f"{database}.features", location)
    train, test = features.temporal_split(table, features.temporal_cutoff(table))
    quality.require_positives(train)
    priors = features.bank_priors(train)
    train, test = features.join_priors(train, priors), features.join_priors(test, priors)
    # The encoding leaves rows with a NULL feature out: say how many.
    skipped = [("train", models.skipped_rows(train)), ("test", models.skipped_rows(test))]
    _save(
        spark.createDataFrame(skipped, "part string, skipped_rows bigint"),
        f"{database}.skipped_rows",
    )
    encoding, train, test = models.encode(train, test)
    for name, part in (("train", train), ("test", test)):
        files.write_parquet(part, f"{folder}/{name}_parquet")
        files.write_training_json(spark.read.parquet(f"{folder}/{name}_parquet"), f"{folder}/{name}")
    models.save_model(encoding, f"{folder}/feature_pipeline")
    discard_staged(staged)


def _publish(spark: SparkSession, frame: DataFrame, database: str, name: str, folder: str) -> None:
    """Result rows as CSV files with an external table over them."""
    location = f"{folder}/output/{name}"
    files.write_csv(frame, location)
    catalog.register_csv(spark, f"{database}.{name}", location, frame.schema)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def train_and_evaluate(
    spark: SparkSession,
    database: str,
    folder: str,
    candidates: Sequence[models.Candidate] | None = None,
    alerts_per_day: int = evaluation.ALERTS_PER_DAY,
) -> None:
    """Stage 3b: train, pin, score and compare the models with the rules."""
    train = spark.read.parquet(f"{folder}/train_parquet")
    test = spark.read.parquet(f"{folder}/test_parquet")
    schemes = spark.table(f"{database}.{SCHEMES}")
    staged = staged_count()
    inner, calibration = models.calibration_split(train)
    balanced = models.balance_classes(inner)
    results = []
    for candidate in candidates or [models.logistic_candidate(), models.trees_candidate()]:
        trained = models.cross_validate(candidate, balanced)
        short = candidate.name.split("_")[0]
        models.save_model(trained.model, f"{folder}/models/{short}")
        scored = models.score_once(trained.model, test)
        _publish(spark, models.prediction_rows(scored), database, f"{short}_predictions", folder)
        _publish(spark, models.probability_rows(scored), database, f"{short}_probabilities", folder)
        _publish(spark, trained.cv_results, database, f"{short}_cv_results", folder)
        _publish(spark, trained.hyperparameters, database, f"{short}_hyperparams", folder)
        result = models.evaluate_model(
            trained, calibration, test, schemes, alerts_per_day=alerts_per_day, scored=scored
        )
        _publish(spark, result.pinned, database, f"{short}_pinned_threshold", folder)
        results.append(result)
    table = spark.table(f"{database}.features")
    alerts = rules.apply_rules(
        features.temporal_split(table, features.temporal_cutoff(table))[1]
    )
    published = {
        "evaluation": [rules.rule_headline(alerts), *[r.headline for r in results]],
        "eval_threshold_sweep": [r.sweep for r in results],
        "eval_value_sweep": [*[r.values for r in results], evaluation.rule_value_rows(alerts)],
        "eval_pattern_recall": [r.by_pattern for r in results],
        "eval_weekend_weekday": [r.by_segment for r in results],
    }
    for name, frames in published.items():
        _publish(spark, _union(frames), database, name, folder)
    discard_staged(staged)
