"""A full run on the smallest tables: raw files in, evaluation tables out."""

from __future__ import annotations

import pytest
from conftest import SF_TINY

from ledgerlens import jobs
from ledgerlens.plans import models
from ledgerlens.plans.catalogue import REPORTS
from ledgerlens.registry import SECOND
from ledgerlens.session import discard_staged, staged_count, store
from ledgerlens.sources import catalog, derived, files


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    raw = jobs.RawPaths(*[str(folder / name) for name in ("transfers", "schemes", "accounts")], SECOND, True)
    derived.write_transfer_csv(derived.transactions(spark, SF_TINY), raw.transfers, SECOND)
    derived.write_scheme_text(derived.laundering_patterns(spark, SF_TINY), raw.schemes, SECOND)
    files.write_csv(derived.accounts(spark, SF_TINY), raw.accounts)
    catalog.create_database(spark, "aml", str(folder / "warehouse"))
    jobs.load(spark, raw, "aml", until="2024-01-28")
    return str(folder)


def test_load(spark, loaded):
    ledger = spark.table("aml.transactions")
    expected = derived.transactions(spark, SF_TINY).where("txn_date <= '2024-01-28'")
    assert ledger.count() == expected.count()
    assert ledger.select("txn_id", "to_account").exceptAll(expected.select("txn_id", "to_account")).isEmpty()
    assert spark.table("aml.laundering_patterns").count() == derived.laundering_patterns(spark, SF_TINY).count()


def test_reports(spark, loaded):
    names = ["q1", "q8", "b4"]
    assert jobs.run_reports(spark, "aml", names, f"{loaded}/export") == [f"aml.{n}_results" for n in names]
    again = REPORTS["q1"].plan(spark.table("aml.transactions"))
    assert spark.table("aml.q1_results").exceptAll(again).isEmpty()
    header = spark.read.option("header", True).csv(f"{loaded}/export/q8").columns
    assert header == ["bank_id", "name", "in_transactions", "out_transactions", "laundering_ratio"]
    described = jobs.describe(spark, "aml")
    assert {r.table_name for r in described["row_counts"].collect()} == {
        "transactions", "laundering_patterns", "accounts"
    }
    assert described["schema_accounts"].count() == 5 and described["sample_transactions"].count() == 5


def test_features_and_models(spark, loaded):
    jobs.build_features(spark, "aml", loaded)
    candidates = [
        models.logistic_candidate({"regParam": [0.1], "elasticNetParam": [0.0]}, max_iter=3),
        models.trees_candidate({"maxDepth": [2], "subsamplingRate": [1.0]}, max_iter=2),
    ]
    jobs.train_and_evaluate(spark, "aml", loaded, candidates, alerts_per_day=20)
    headline = {r.model: r for r in spark.table("aml.evaluation").collect()}
    assert set(headline) == {"rule_baseline_R1_R2_R5", models.LOGISTIC, models.TREES}
    assert spark.table("aml.evaluation").columns == [
        "model", "precision", "recall", "f1", "pr_auc", "alert_volume"
    ]
    assert spark.table("aml.model1_predictions").columns == ["label", "prediction"]
    row = spark.table("aml.model2_hyperparams").first()
    assert (row.parameter1, row.value1, row.parameter2) == ("maxDepth", "2", "subsamplingRate")
    assert spark.table("aml.eval_value_sweep").where("model = 'rule_baseline_R1_R2_R5'").count() > 0
    assert spark.table("aml.model1_cv_results").count() == 1
    assert {r.part for r in spark.table("aml.skipped_rows").collect()} == {"train", "test"}
    assert spark.table("aml.laundering_patterns_rejects").columns == ["pattern_group", "reason", "line"]


def test_stages_leave_nothing_staged(spark, loaded):
    before = staged_count()
    kept = store(spark.range(3))
    assert staged_count() == before + 1 and kept.count() == 3
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    discard_staged(before)
    assert staged_count() == before
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(folder).count()
