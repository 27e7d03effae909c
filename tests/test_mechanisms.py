"""Compiled models, exact areas, long encodings, folds, layouts and sketches."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import SF_TINY
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens import registry
from ledgerlens.operators import trailing
from ledgerlens.operators.ordering import ranked_totals
from ledgerlens.plans import evaluation, features, models, scoring, sketches
from ledgerlens.plans.features import add_row_features
from ledgerlens.sources import derived, files, warehouse

NAMES = ["a", "b", "kind"]


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(5)
    rows = []
    for key in range(400):
        a, b, kind = draw.uniform(-2, 2), draw.randint(0, 9), float(draw.randint(0, 3))
        rows.append((key, a, b, kind, int(a + 0.2 * b + (kind == 2) + draw.gauss(0, 0.7) > 1.5)))
    frame = spark.createDataFrame(rows, "txn_id bigint, a double, b int, kind double, label int")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame).cache()


@pytest.mark.parametrize(
    "estimator, settings",
    [(LogisticRegression, {"maxIter": 20, "regParam": 0.01}), (GBTClassifier, {"maxIter": 8, "maxDepth": 4, "seed": 3})],
)
def test_compiled_model_scores_like_the_fitted_one(labelled, estimator, settings):
    fitted = estimator(**settings).fit(labelled)
    compiled = scoring.from_fitted(fitted, NAMES)
    theirs = fitted.transform(labelled).select(
        "txn_id", vector_to_array("probability")[1].alias("theirs"), F.col("prediction").alias("decided")
    )
    ours = scoring.score_rows(labelled.select("txn_id", *NAMES), compiled).join(theirs, "txn_id")
    for row in ours.withColumn("sql", F.expr(scoring.probability_sql(compiled))).collect():
        assert abs(row["proba_positive"] - row["theirs"]) < 1e-9
        assert abs(row["sql"] - row["theirs"]) < 1e-9
        assert row["prediction"] == int(row["decided"])


def test_compiled_model_needs_no_vector_and_keeps_nulls(spark):
    rows = spark.createDataFrame([(None, 1, 1, 1, 1.0)], "log_amount double, currency_mismatch int, "
                                 "is_weekend int, hour_of_day int, log10_amount_bucket double")
    assert scoring.score_rows(rows, scoring.STATED_LINEAR).first()["proba_positive"] is None
    with pytest.raises(ValueError):
        scoring.from_fitted(
            LogisticRegression().fit(
                VectorAssembler(inputCols=["x"], outputCol="features").transform(
                    spark.createDataFrame([(0.0, 0), (1.0, 1)], "x double, label int")
                )
            ),
            ["x", "y"],
        )


def test_area_equals_the_library(spark, labelled):
    scored = LogisticRegression(maxIter=5).fit(labelled).transform(labelled).withColumn(
        "proba_positive", F.round(vector_to_array("probability")[1], 2)  # many ties
    )
    library = BinaryClassificationEvaluator(
        rawPredictionCol="proba_positive", metricName="areaUnderPR", numBins=0
    ).evaluate(scored)
    row = evaluation.area_under_pr(scored).first()
    assert abs(row["area"] - library) < 1e-9 and row["n"] == 400 and row["n_scores"] < 101
    none = evaluation.area_under_pr(scored.where("label = 0")).first()
    assert none["area"] is None and none["positives"] == 0
    assert evaluation.area_under_pr(scored.where("false")).first()["n"] == 0


def test_ranked_totals(spark):
    draw = random.Random(2)
    rows = [(key, draw.randint(0, 50)) for key in draw.sample(range(10**6), 3000)]
    frame = spark.createDataFrame(rows, "key bigint, n bigint").repartition(7)
    found = {row["key"]: row["upto"] for row in ranked_totals(frame, [F.col("key")], {"upto": "n"}).collect()}
    total = 0
    for key, n in sorted(rows):
        total += n
        assert found[key] == total


def test_long_encoding_equals_the_vector(spark):
    rows = [
        ("Cash", "Euro", "Yen", 0.5, 1), ("Cash", "Euro", "Euro", 0.0, 2), ("Wire", "Yen", "Yen", 1.5, 3),
        ("New", "Yen", "Euro", 2.0, 4), ("Cash", "Euro", "Yen", None, 5),
    ]
    kinds = "payment_format string, payment_currency_bucket string, receiving_currency_bucket string, x double, txn_id int"
    frame = spark.createDataFrame(rows, kinds)
    train = frame.where("payment_format <> 'New'")
    index = models.category_index(train)
    indexer, one_hot, _ = models.encoding_pipeline().getStages()[-3:]
    indexed = indexer.fit(train)
    hot = one_hot.fit(indexed.transform(train)).transform(indexed.transform(frame))
    vector = VectorAssembler(
        inputCols=[*one_hot.getOutputCols(), "x"], outputCol="features", handleInvalid="skip"
    ).transform(hot)
    wanted = {
        (row["txn_id"], at, value)
        for row in vector.select("txn_id", vector_to_array("features").alias("v")).collect()
        for at, value in enumerate(row["v"])
        if value
    }
    found = models.encode_long(frame, index, ["x"]).collect()
    assert {(r["txn_id"], r["position"], r["value"]) for r in found if not r["skipped"]} == wanted
    assert [(r["txn_id"], r["position"]) for r in found if r["skipped"]] == [(5, None)]


def test_folds_follow_the_key(spark):
    rows = spark.range(3000).withColumnRenamed("id", "txn_id")
    one = {r["txn_id"]: r["fold"] for r in models.with_folds(rows).collect()}
    two = {r["txn_id"]: r["fold"] for r in models.with_folds(rows.repartition(13)).collect()}
    assert one == two and set(one.values()) == {0, 1, 2}
    assert min(list(one.values()).count(fold) for fold in range(3)) > 900
    assert 150 < models.bounded_rows(rows, 200).count() < 250
    assert models.bounded_rows(rows, 3000).count() == 3000


def test_cross_validation_by_folds(spark, labelled):
    candidate = models.logistic_candidate({"regParam": [0.001, 1.0]}, max_iter=5)
    train = labelled.withColumn("weight", F.lit(1.0))
    first, again = (models.cross_validate(candidate, frame) for frame in (train, train.repartition(5)))
    scores = [[row["avg_pr_auc"] for row in one.cv_results.orderBy("combo_idx").collect()] for one in (first, again)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9) and len(scores[0]) == 2


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    ledger = derived.transactions(spark, SF_TINY)
    joined = registry.bucketed_profiles(ledger)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert joined.count() > 0


def test_reload_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = [(key, date(2024, 1, 1 + key % 3)) for key in range(30)]
    ledger = spark.createDataFrame(rows, "txn_id int, txn_date date")
    warehouse.save_ledger_files(ledger, path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        warehouse.reload_days(ledger.where("txn_date = DATE '2024-01-02' AND txn_id < 10"), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    found = {r["txn_date"].day: r["count"] for r in spark.read.parquet(path).groupBy("txn_date").count().collect()}
    assert found == {1: 10, 2: 3, 3: 10}
    listed = files.file_relation(spark.read.parquet(path)).collect()
    assert sum(row["rows"] for row in listed) == 23 and all(row["bytes"] > 0 for row in listed)


def test_sketches_of_days_merge(spark):
    rows = spark.range(200_000).select(
        F.col("id").alias("ts_unix"), (F.col("id") % 30_011).alias("account"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("txn_date"),
    )
    daily = sketches.daily_sketches(rows, ["account"], ["ts_unix"])
    assert daily.count() == 9
    row = sketches.distinct_check(rows, daily, "account").first()
    assert row["exact"] == 30_011 and row["within_bound"] and row["days"] == 9
    checks = sketches.quantile_check(rows, daily, "ts_unix", [0.1, 0.5, 0.99]).collect()
    assert [check["within_bound"] for check in checks] == [True] * 3
    off = sketches.daily_sketches(rows.where("ts_unix < 100000"), ["account"], ["ts_unix"])
    assert not sketches.quantile_check(rows, off, "ts_unix", [0.9]).first()["within_bound"]


def test_priors_without_the_own_row(spark):
    rows = [(1, 1, 7, 1), (2, 1, 8, 0), (3, 2, 7, 0), (4, 1, 7, 1)]
    train = spark.createDataFrame(rows, "txn_id int, from_bank int, to_bank int, label int")
    found = {row["txn_id"]: row for row in features.left_out_priors(train, strength=2).collect()}
    for key, bank, _, label in rows:
        others = [r for r in rows if r[0] != key]
        overall = sum(r[3] for r in others) / len(others)
        same = [r for r in others if r[1] == bank]
        wanted = (sum(r[3] for r in same) + 2 * overall) / (len(same) + 2)
        assert abs(found[key][features.SENDER_PRIOR] - wanted) < 1e-12
        assert found[key]["label"] == label


def test_inflow_of_the_sending_account(spark, make_ledger):
    draw = random.Random(9)
    rows = [
        {"s": draw.randint(0, 3 * 86400), "src": draw.choice("ABC"), "dst": draw.choice("BCD"), "amount": draw.randint(1, 99)}
        for _ in range(120)
    ]
    base = add_row_features(make_ledger(rows))
    found = trailing.add_counterpart(base, trailing.RECEIVER, "from_account", base)
    for row in found.collect():
        own = rows[row["txn_id"] - 1]
        took = [r["amount"] for r in rows if r["dst"] == own["src"] and own["s"] - 86400 <= r["s"] <= own["s"]]
        assert row["in_count_24h"] == len(took) and float(row["in_sum_24h"]) == sum(took)


def test_amounts_beyond_64_bits(spark, make_ledger):
    """Units of a large amount need more than 64 bits; sums and extremes stay exact."""
    from decimal import Decimal

    amounts = [Decimal("9999999999999999.9999"), Decimal("0.0001"), Decimal("-5000000000000000.5"), Decimal("-7.25")]
    rows = [{"s": at, "amount": amount} for at, amount in enumerate(amounts)]
    base = add_row_features(make_ledger([{**row, "amount": str(row["amount"])} for row in rows]))
    found = trailing.add_trailing(base, trailing.SENDER, base).orderBy("ts_unix").collect()
    for at, row in enumerate(found):
        assert row["out_sum_24h"] == sum(amounts[: at + 1])
        assert row["out_max_24h"] == max(amounts[: at + 1]) and row["out_min_24h"] == min(amounts[: at + 1])
