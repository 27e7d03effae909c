from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import binning, labels, rates
from ledgerlens.plans.activity import amount_decades, structuring_histogram
from ledgerlens.plans.features import add_row_features


def values(spark, rows, schema, expression):
    frame = spark.createDataFrame(rows, schema)
    return [row[0] for row in frame.select(expression(frame)).collect()]


def test_bins_are_half_open(spark):
    amounts = ["0.01", "0.5", "1", "9.99", "10", "999999999", "1000000000"]
    got = values(
        spark,
        [(Decimal(a),) for a in amounts],
        "a decimal(20,4)",
        lambda f: binning.bin_by_edges(
            f.a, binning.AMOUNT_DECADE_EDGES, binning.AMOUNT_DECADE_LABELS
        ),
    )
    assert got == [-1, -1, 0, 0, 1, 8, 9]


def test_bins_need_matching_labels(spark):
    with pytest.raises(ValueError):
        binning.bin_by_edges(F.lit(1), [1, 2], ["a", "b"])


@pytest.mark.parametrize(
    "size,bucket",
    [(1, "1"), (2, "2"), (3, "3-9"), (9, "3-9"), (10, "10-99"), (100, "100-999"),
     (1000, "1K-9.9K"), (99999, "10K-99.9K"), (100000, "100K-999K"), (1000000, "1M+")],
)
def test_component_buckets(spark, size, bucket):
    expression = binning.bin_by_edges(
        F.lit(size), binning.COMPONENT_SIZE_EDGES, binning.COMPONENT_SIZE_LABELS
    )
    assert spark.range(1).select(expression).first()[0] == bucket


def test_canonical_type(spark):
    raw = ["GATHER-SCATTER: MAX 16", "SCATTER-GATHER", "fan-in: max 3", "FAN-OUT", "Stacked",
           "SCATTER", "weird", ""]
    got = values(spark, [(r,) for r in raw], "t string", lambda f: labels.canonical_type(f.t))
    assert got == ["GATHER-SCATTER", "SCATTER-GATHER", "FAN-IN", "FAN-OUT", "STACK",
                   "OTHER", "OTHER", "OTHER"]


def test_currency_bucket_and_label(spark):
    got = values(
        spark, [("Euro",), ("Rupee",), (None,)], "c string", lambda f: labels.currency_bucket(f.c)
    )
    assert got == ["Euro", "Other", "Other"]
    got = values(
        spark, [(7, "Seven"), (8, None)], "i int, n string", lambda f: labels.bank_label(f.i, f.n)
    )
    assert got == ["7 — Seven", "8"]


def test_rates_with_empty_denominator(spark):
    rows, kinds = [(1, 3), (0, 0)], "a int, b int"
    assert values(spark, rows, kinds, lambda f: rates.rounded_ratio(f.a, f.b)) == [0.333333, None]
    assert values(spark, rows, kinds, lambda f: rates.ratio_or_zero(f.a, f.b)) == [1 / 3, 0.0]
    assert values(spark, rows, kinds, lambda f: rates.percent(f.a, f.b)) == [33.333333, 0.0]
    # 100 / 512 ends in a 5 at the seventh decimal.
    assert values(spark, [(1, 512)], kinds, lambda f: rates.percent(f.a, f.b)) == [0.195313]


def test_log_buckets_follow_the_amount(make_ledger):
    ledger = make_ledger([{"amount": a} for a in ("0", "0.01", "0.5", "1", "10", "1e12")])
    got = add_row_features(ledger).orderBy("txn_id").select("log10_amount_bucket").collect()
    assert [r[0] for r in got] == [0, -1, 0, 1, 2, 10]


def test_amount_reports_at_their_edges(make_ledger):
    ledger = make_ledger(
        [{"amount": a} for a in ("0", "6999.99", "7000", "7049.99", "7050", "12000", "12000.01")]
    )
    got = {(r.bin_lo, r.n) for r in structuring_histogram(ledger).collect()}
    assert got == {(7000, 2), (7050, 1), (12000, 1)}
    assert sum(r.n for r in amount_decades(ledger).collect()) == 6
    assert structuring_histogram(ledger, currency="Euro").isEmpty()
