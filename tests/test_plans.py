"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from conftest import SF_TINY

from ledgerlens import registry
from ledgerlens.operators import trailing
from ledgerlens.plans import accounts, activity, banks, features
from ledgerlens.sources import derived, warehouse

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
TRAINING = {"e1_logistic_headline", "e1_trees_headline"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ledger") / "transactions")
    warehouse.save_ledger_files(derived.transactions(spark, SF_TINY), path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(registry.all_queries()) - TRAINING))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(registry.all_queries()[name](spark, SF_TINY))
    assert not [word for word in FORBIDDEN if word in plan]


def read_columns(frame):
    found = re.findall(r"ReadSchema: struct<([^>]*)>", frame._jdf.queryExecution().toString())
    return set().union(*[{part.split(":")[0] for part in text.split(",")} for text in found])


def test_scans_read_only_what_a_report_needs(stored):
    assert read_columns(activity.hour_by_weekday(stored)) == {"ts", "is_laundering"}
    assert read_columns(accounts.account_degrees(stored)) == {
        "from_account", "to_account", "is_laundering"
    }
    assert read_columns(banks.bank_activity(stored)) == {"from_bank", "to_bank", "is_laundering"}


def test_filters_reach_the_scan(stored):
    plan = plan_of(activity.structuring_histogram(stored))
    assert "GreaterThanOrEqual(amount_paid,7000" in plan
    plan = plan_of(activity.daily_rate(warehouse.active_window(stored, "2024-01-10")))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan)
    plan = plan_of(features.first_days(stored, "2024-01-01", 3))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan)


def test_profiles_scan_once_and_shuffle_once(stored):
    for report in (accounts.account_degrees, activity.format_by_label):
        plan = plan_of(report(stored))
        assert plan.count("FileScan") == 1
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_" in plan


def test_one_side_is_computed_alone_and_late_rows_are_read_alone(stored):
    sender = plan_of(features.build_features(stored, (trailing.SENDER,)).select("out_count_24h"))
    assert "in_" not in sender and "amount" not in "".join(
        line for line in sender.splitlines() if "Window" in line
    )
    plan = plan_of(features.recent_rows(stored, 1_706_000_000))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan)


def test_corridor_reports_do_not_join_the_ledger(stored):
    for report in (banks.top_bank_matrix, banks.top_rank_matrix, banks.consortium_histogram):
        assert "FileScan" not in plan_of(report(stored))
