from __future__ import annotations

from conftest import SF_TINY
from pyspark.sql import functions as F

from ledgerlens.plans import accounts, activity, banks, rollups
from ledgerlens.sources import derived


def schemes_of(ledger, group=1, kind="FAN-IN"):
    return ledger.withColumns(
        {"pattern_group": F.lit(group), "pattern_type": F.lit(kind), "pattern_id": F.col("txn_id")}
    )


def test_intra_bank_edge_is_seen_once(make_ledger):
    ledger = make_ledger([{"fb": 1, "tb": 1}, {"fb": 1, "tb": 2}, {"fb": 3, "tb": 2}])
    row = banks.scheme_visibility(ledger, schemes_of(ledger), k=1).first()
    # Bank 1 (three ends) is the only member.
    assert row.n_edges_total == 3
    assert row.isolated_visible_edges == 2
    assert row.loose_consortium_edges == 2
    assert row.strict_consortium_edges == 1


def test_ties_go_to_the_smaller_bank(make_ledger):
    ledger = make_ledger([{"fb": 5, "tb": 4}, {"fb": 4, "tb": 5}])
    got = {(r.coverage_type, r.k): r.n_at_k for r in banks.consortium_histogram(ledger).collect()}
    assert got == {("loose", 1): 2, ("strict", 2): 2}
    ranks = banks.top_rank_matrix(ledger, k=1).collect()
    assert ranks == []


def test_bank_on_one_side_and_without_name(spark, make_ledger):
    ledger = make_ledger([{"fb": 1, "tb": 2, "flag": 1}])
    names = spark.createDataFrame(
        [("Z", 1, "a", "e", "n"), ("A", 1, "b", "e", "n")],
        "bank_name string, bank_id bigint, account_number string, entity_id string, entity_name string",
    )
    got = {r.bank_id: (r.name, r.in_transactions, r.out_transactions, r.laundering_ratio)
           for r in banks.bank_risk(ledger, names).collect()}
    assert got == {1: ("A", 0, 1, 1.0), 2: (None, 1, 0, 1.0)}


def test_busy_corridors_threshold(make_ledger):
    ledger = make_ledger([{"fb": 1, "tb": 2}] * 3 + [{"fb": 2, "tb": 1}])
    got = banks.busy_corridors(ledger, min_rows=3).collect()
    assert [(r.from_bank, r.to_bank, r.n_total) for r in got] == [(1, 2, 3)]


def test_totals_agree_across_reports(spark):
    ledger = derived.transactions(spark, SF_TINY)
    schemes = derived.laundering_patterns(spark, SF_TINY)
    rows = ledger.count()
    total = lambda frame, column: frame.agg(F.sum(column)).first()[0]
    assert total(activity.format_by_label(ledger), "n") == rows
    assert total(banks.bank_activity(ledger), "tx_count") == 2 * rows
    degrees = accounts.degree_histogram(ledger).withColumn("w", F.col("deg") * F.col("n_accounts"))
    assert {r["s"] for r in degrees.groupBy("direction").agg(F.sum("w").alias("s")).collect()} == {rows}
    coverage = banks.consortium_histogram(ledger)
    sums = coverage.groupBy("coverage_type").agg(F.sum("n_at_k").alias("s")).collect()
    assert {r["s"] for r in sums} == {rows}
    assert total(accounts.component_sizes(ledger), "size") == accounts.account_degrees(ledger).count()
    seen = banks.scheme_visibility(ledger, schemes, k=5)
    bad = "strict_consortium_edges > loose_consortium_edges or loose_consortium_edges > n_edges_total"
    assert seen.where(bad).isEmpty()


def test_curve_ends_at_one_hundred_percent(spark):
    histogram = banks.consortium_histogram(derived.transactions(spark, SF_TINY))
    ends = rollups.coverage_curve(histogram).groupBy("coverage_type", "is_laundering").agg(
        F.max("coverage_pct").alias("end")
    )
    assert {r.end for r in ends.collect()} == {100.0}


def test_scatter_draws_a_share_by_name(spark):
    degrees = accounts.account_degrees(derived.transactions(spark, "/root/testdata/sf0.01"))
    some, more = rollups.scatter_accounts(degrees, 0.3), rollups.scatter_accounts(degrees, 0.6)
    assert 0.15 < some.count() / degrees.count() < 0.45
    assert some.exceptAll(more).isEmpty()
    assert rollups.scatter_accounts(degrees.repartition(7), 0.3).exceptAll(some).isEmpty()
