from __future__ import annotations

import math

import pytest
from conftest import SF_TINY
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlens import registry
from ledgerlens.operators.encoders import SinCosEncoder
from ledgerlens.operators.thresholds import at_thresholds
from ledgerlens.plans import evaluation, features, models, rules
from ledgerlens.sources import derived, files


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Encoded train and test rows of the smallest ledger."""
    ledger = derived.transactions(spark, SF_TINY)
    folder = str(tmp_path_factory.mktemp("features"))
    table = features.write_features(features.build_features(ledger), folder)
    train, test = features.temporal_split(table, features.temporal_cutoff(table))
    priors = features.bank_priors(train)
    train, test = features.join_priors(train, priors), features.join_priors(test, priors)
    encoding, encoded_train, encoded_test = models.encode(train, test)
    return {
        "train": train, "encoding": encoding,
        "encoded_train": encoded_train.persist(), "encoded_test": encoded_test.persist(),
    }


def test_encoder_values_and_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(h,) for h in (0, 6, 12, 18)], "hour int")
    encoder = SinCosEncoder(inputCol="hour", period=24.0)
    got = encoder.transform(frame).orderBy("hour").collect()
    assert [round(r.hour_sin, 9) for r in got] == [0, 1, 0, -1]
    assert [round(r.hour_cos, 9) for r in got] == [1, 0, -1, 0]
    fitted = Pipeline(stages=[encoder]).fit(frame)
    models.save_model(fitted, str(tmp_path / "pipeline"))
    again = models.load_encoding(str(tmp_path / "pipeline"))
    assert again.stages[0].getPeriod() == 24.0 and again.stages[0].getInputCol() == "hour"
    assert again.transform(frame).collect() == fitted.transform(frame).collect()
    with pytest.raises(ValueError):
        SinCosEncoder(inputCol="hour", period=0.0).transform(frame)


def test_split_is_disjoint_in_time(prepared):
    last = prepared["encoded_train"].agg(F.max("ts_unix")).first()[0]
    first = prepared["encoded_test"].agg(F.min("ts_unix")).first()[0]
    assert last < first
    assert models.skipped_rows(prepared["train"]) == 0
    inner, calibration = models.calibration_split(prepared["encoded_train"])
    assert inner.agg(F.max("ts_unix")).first()[0] < calibration.agg(F.min("ts_unix")).first()[0]
    total = prepared["encoded_train"].count()
    assert inner.count() + calibration.count() == total
    assert 0.05 < calibration.count() / total < 0.15


def test_priors(spark, monkeypatch):
    rows = [(1, 9, 1)] * 3 + [(1, 9, 0)] * 7 + [(2, 9, 0)] * 10
    train = spark.createDataFrame(rows, "from_bank int, to_bank int, label int")
    priors = features.bank_priors(train)
    assert priors.overall == 0.15
    got = {r.from_bank: r.from_bank_laundering_rate_prior for r in priors.senders.collect()}
    assert got[1] == pytest.approx((3 + 20 * 0.15) / 30)
    assert got[2] == pytest.approx((0 + 20 * 0.15) / 30)
    unseen = spark.createDataFrame([(77, 9, 0)], "from_bank int, to_bank int, label int")
    assert features.join_priors(unseen, priors).first().from_bank_laundering_rate_prior == 0.15
    assert [r.from_bank for r in features.riskiest_banks(priors, 1).collect()] == [1]


def test_balance(spark):
    rows = [(i, 1 if i < 50 else 0) for i in range(20_000)]
    train = spark.createDataFrame(rows, "txn_id bigint, label int")
    balanced = models.balance_classes(train, negatives_per_positive=10)
    counts = {r.label: (r.n, r.w) for r in balanced.groupBy("label").agg(
        F.count("*").alias("n"), F.max("weight").alias("w")).collect()}
    assert counts[1][0] == 50
    assert abs(counts[0][0] - 500) < 100
    assert counts[1][1] == counts[0][0] / 50 and counts[0][1] == 1.0
    again = models.balance_classes(train.repartition(13), negatives_per_positive=10)
    assert again.exceptAll(balanced).isEmpty()
    with pytest.raises(ValueError):
        models.balance_classes(train.where("label = 0"))


def test_published_grids():
    assert len(models.logistic_candidate().combinations()) == 18
    assert len(models.trees_candidate().combinations()) == 12
    assert models.trees_candidate().estimator.getMaxIter() == 50
    assert models.logistic_candidate().estimator.getMaxIter() == 100


@pytest.mark.parametrize("build", ["logistic", "trees"])
def test_train_pin_evaluate_save(spark, tmp_path, prepared, build):
    candidate = (
        models.logistic_candidate({"regParam": [0.01, 0.1]}, max_iter=5)
        if build == "logistic"
        else models.trees_candidate({"maxDepth": [2]}, max_iter=2)
    )
    inner, calibration = models.calibration_split(prepared["encoded_train"])
    trained = models.cross_validate(candidate, models.balance_classes(inner, 5, partitions=2), folds=2)
    assert trained.cv_results.count() == len(candidate.combinations())
    shown = trained.hyperparameters.first()
    assert shown.parameter1 in candidate.grid and float(shown.value1) > 0
    schemes = derived.laundering_patterns(spark, SF_TINY)
    result = models.evaluate_model(
        trained, calibration, prepared["encoded_test"], schemes, alerts_per_day=20
    )
    pinned = result.pinned.first()
    assert pinned.pinned_threshold in evaluation.CALIBRATION_GRID
    headline = result.headline.first()
    assert 0 <= headline.pr_auc <= 1
    at_pin = result.sweep.where("is_pinned").collect()
    assert len(at_pin) == 1 and at_pin[0].alert_volume == headline.alert_volume
    assert result.values.columns[0] == "model"
    assert result.by_segment.count() <= 2
    models.save_model(trained.model, str(tmp_path / "model"))
    again = models.load_classifier(candidate.name, str(tmp_path / "model"))
    test = prepared["encoded_test"]
    assert models.prediction_rows(models.score(again, test)).exceptAll(
        models.prediction_rows(models.score(trained.model, test))
    ).isEmpty()
    files.write_csv(models.probability_rows(models.score(again, test)), str(tmp_path / "probabilities"))
    assert files.read_scored(spark, str(tmp_path / "probabilities")).count() == test.count()


def test_encoding_round_trip_and_json(spark, tmp_path, prepared):
    models.save_model(prepared["encoding"], str(tmp_path / "encoding"))
    again = models.load_encoding(str(tmp_path / "encoding"))
    assert isinstance(again, PipelineModel)
    columns = ["txn_id", "features"]
    before = prepared["encoding"].transform(prepared["train"]).select(*columns)
    assert again.transform(prepared["train"]).select(*columns).orderBy("txn_id").collect() == before.orderBy("txn_id").collect()
    files.write_training_json(prepared["encoded_test"], str(tmp_path / "json"), single_file=True)
    assert len(list((tmp_path / "json").glob("*.json.gz"))) == 1
    assert set(spark.read.json(str(tmp_path / "json")).columns) == {"features", "label"}


SCORES = [(1, 0.9, 10.0), (0, 0.8, 5.0), (1, 0.8, 7.0), (0, 0.29, 1.0), (1, 0.05, 2.0), (0, None, 4.0)]
SCORED = "label int, proba_positive double, amount_paid double"


def test_thresholds_match_brute_force(spark):
    frame = spark.createDataFrame(SCORES, SCORED)
    grid = [0.05, 0.28, 0.29, 0.8, 0.95]
    got = {r.threshold: r for r in at_thresholds(frame, grid, amount="amount_paid").collect()}
    assert sorted(got) == grid
    for threshold, row in got.items():
        hit = [s for s in SCORES if s[1] is not None and s[1] >= threshold]
        assert row.positives == 3
        assert row.tp == sum(s[0] for s in hit) and row.fp == len(hit) - row.tp
        assert row.tp_value == sum(s[2] for s in hit if s[0]) and row.total_value == 19.0
        assert row.fp_value == sum(s[2] for s in hit if not s[0])


@pytest.mark.parametrize(
    "budget,threshold", [(3, 0.8), (1, 0.9), (100, 0.05), (0, 0.95)],
    ids=["ties go up", "tight", "loose", "no alert fits but the top one"],
)
def test_pinning(spark, budget, threshold):
    frame = spark.createDataFrame(SCORES, SCORED).withColumn("ts_unix", F.lit(0).cast("bigint"))
    row = evaluation.pin_threshold(frame, "m", [0.05, 0.7, 0.8, 0.9, 0.95], budget).first()
    assert row.pinned_threshold == threshold and row.calibration_days == 1.0


def test_pinning_when_nothing_fits(spark):
    frame = spark.createDataFrame([(0, 0.99, 1.0)] * 3, SCORED).withColumn("ts_unix", F.lit(0).cast("bigint"))
    row = evaluation.pin_threshold(frame, "m", [0.5, 0.9], 1).first()
    assert row.pinned_threshold == 0.9 and row.calibration_alerts == 3


def test_repeated_keys_count_against_each_other(spark, make_ledger):
    schemes = make_ledger([{"s": 5, "flag": 1}] * 3 + [{"s": 6, "flag": 1}]).withColumns(
        {"pattern_type": F.lit("Cycle: x"), "pattern_group": F.lit(1)}
    )
    rows = [(1, 1, 5)] * 2 + [(1, 0, 5), (0, 1, 5), (1, 1, 6), (1, 1, 7)]
    predictions = spark.createDataFrame(rows, "label int, prediction int, ts_unix bigint").withColumns(
        {"from_account": F.lit("A"), "to_account": F.lit("B")}
    )
    row = evaluation.pattern_recall(predictions, schemes, "m").first()
    assert (row.canon_type, row.n_total, row.n_caught, row.recall) == ("CYCLE", 10, 7, 0.7)
    repeated = evaluation.duplicate_pattern_keys(schemes).first()
    assert (repeated.n_keys, repeated.n_rows) == (1, 3)


RULE_COLUMNS = (
    "out_count_24h int, out_max_24h double, out_sum_24h double, in_count_24h int, "
    "out_count_1h int, in_sum_24h double, out_sum_1h double, out_unique_banks_24h int, label int"
)


def test_rules_at_their_limits(spark):
    rows = [
        (5, 9999.99, 30000.01, 0, 0, 0.0, 0.0, 1, 1),
        (5, 10000.0, 30000.01, 0, 0, 0.0, 0.0, 1, 0),
        (5, 9999.99, 30000.0, 0, 0, 0.0, 0.0, 1, 0),
        (1, 1.0, 1.0, 3, 3, 100.0, 91.0, 1, 1),
        (1, 1.0, 1.0, 3, 3, 100.0, 90.0, 1, 0),
        (10, 99999.0, 1.0, 0, 0, 0.0, 0.0, 5, 0),
        (9, 99999.0, 1.0, 0, 0, 0.0, 0.0, 5, 0),
    ]
    scored = rules.apply_rules(spark.createDataFrame(rows, RULE_COLUMNS))
    got = [tuple(r) for r in scored.select(*rules.RULES).collect()]
    assert got == [(1, 0, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0), (0, 1, 0, 1), (0, 0, 0, 0),
                   (0, 0, 1, 1), (0, 0, 0, 0)]
    metrics = {r.rule: r for r in rules.rule_metrics(scored).collect()}
    assert (metrics["rule_alert"].tp, metrics["rule_alert"].fp) == (2, 1)
    assert metrics["rule_alert"].precision == 2 / 3 and metrics["rule_alert"].recall == 1.0
    assert metrics["r5_cross_bank"].f1 == 0.0
    headline = rules.rule_headline(scored).first()
    assert math.isnan(headline.pr_auc) and headline.alert_volume == 3


def test_clamped_bucket(spark, make_ledger):
    ledger = make_ledger([{"amount": amount} for amount in ("0.01", "0.5", "5", "50")])
    free = features.add_row_features(ledger).orderBy("txn_id").collect()
    held = features.add_row_features(ledger, clamp_bucket=True).orderBy("txn_id").collect()
    assert [r.log10_amount_bucket for r in free] == [-1, 0, 1, 2]
    assert [r.log10_amount_bucket for r in held] == [0, 0, 1, 2]


def test_subsets(spark):
    ledger = derived.transactions(spark, SF_TINY)
    assert features.first_days(ledger, "2024-01-01", 2).select("txn_date").distinct().count() == 2
    drawn = features.sample_rows(ledger, 0.3)
    assert 0.2 < drawn.count() / ledger.count() < 0.4
    assert features.sample_rows(ledger.repartition(9), 0.3).exceptAll(drawn).isEmpty()
    with pytest.raises(ValueError):
        features.temporal_cutoff(spark.createDataFrame([], "ts_unix bigint"))


@pytest.mark.parametrize(
    "name, combinations, rounds", [("logistic_headline", 18, 100), ("trees_headline", 12, 50)]
)
def test_registered_models_search_the_whole_grid(spark, monkeypatch, name, combinations, rounds):
    asked = []
    monkeypatch.setattr(registry, "_model_headline", lambda candidate, *tables: asked.append(candidate))
    getattr(registry, name)(None, None)
    assert len(asked[0].combinations()) == combinations
    assert asked[0].estimator.getMaxIter() == rounds


def test_cross_validation_runs_few_tasks_a_job(spark, monkeypatch):
    """60,000 rows are one task of each of the thousands of jobs."""
    seen = []

    class Stopped(Exception):
        pass

    class Watched(models.CrossValidator):
        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count(), self.getParallelism()))
            raise Stopped

    monkeypatch.setattr(models, "CrossValidator", Watched)
    rows = spark.range(60_000).selectExpr("id AS txn_id", "id AS features", "1 AS label", "1.0D AS weight")
    with pytest.raises(Stopped):
        models.cross_validate(models.logistic_candidate(), rows)
    assert seen == [(1, 60_000, 8)]


def test_cross_validation_fits_all_rows(spark, monkeypatch):
    """Also of more than 2,000,000 rows, of which about 2,000,000 were drawn before."""
    seen = []

    class Stopped(Exception):
        pass

    class Watched(models.CrossValidator):
        def fit(self, train):
            seen.append(train.agg(F.count("*"), F.sum("features")).first())
            raise Stopped

    monkeypatch.setattr(models, "CrossValidator", Watched)
    rows = spark.range(2_100_000).selectExpr("id AS txn_id", "id AS features", "1 AS label", "1.0D AS weight")
    with pytest.raises(Stopped):
        models.cross_validate(models.logistic_candidate(), rows)
    assert tuple(seen[0]) == (2_100_000, 2_100_000 * 2_099_999 // 2)


def test_large_tables_are_fitted_few_at_a_time():
    """Every fit keeps its rows: 8 at a time of any size filled memory, then disk."""
    assert [models.fits_at_a_time(rows, 12) for rows in (0, 72_000, 4_300_000, 26_000_000)] == [12, 12, 3, 1]
    assert models.fits_at_a_time(72_000, 2) == 8


def test_models_store_what_they_read(spark, monkeypatch):
    """The stored feature table has no column that nothing reads, and shuffles none to get it."""
    ledger, kept = derived.transactions(spark, SF_TINY), []
    monkeypatch.setattr(registry, "store", lambda table: kept.append(table) or table)
    registry._encoded(ledger)
    assert set(kept[0].columns) == models.MODEL_COLUMNS
    assert features.build_features(ledger).columns[:3] == ["to_account", "ts_unix", "from_account"]
    full = features.build_features(ledger).select("txn_id", *features.ROW_FEATURES)
    alone = features.add_row_features(ledger).select("txn_id", *features.ROW_FEATURES)
    assert full.exceptAll(alone).isEmpty() and full.count() == alone.count()
