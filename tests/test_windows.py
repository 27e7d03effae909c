"""Trailing features: edge cases by hand, and against brute force with a dominating account."""

from __future__ import annotations

import math
import random
import statistics

import pytest

from ledgerlens import registry
from ledgerlens.operators import trailing
from ledgerlens.plans.features import add_row_features, build_features

DAY = 86400


def brute_force(rows):
    """txn number -> expected features, from the plain definition."""
    expected = {}
    for number, row in enumerate(rows, start=1):
        def frame(key, span):
            return [r for r in rows if r[key] == row[key] and row["s"] - span <= r["s"] <= row["s"]]

        out, incoming, hour = frame("src", DAY), frame("dst", DAY), frame("src", 3600)

        def deviation(amounts):
            return statistics.stdev(amounts) if len(amounts) > 1 else 0.0

        paid = [r["amount"] for r in out]
        received = [r["amount"] for r in incoming]
        expected[number] = {
            "out_count_24h": len(out), "out_sum_24h": sum(paid),
            "out_mean_24h": sum(paid) / len(paid), "out_std_24h": deviation(paid),
            "out_max_24h": max(paid), "out_min_24h": min(paid),
            "out_unique_dst_24h": len({r["dst"] for r in out}),
            "out_unique_banks_24h": len({r["tb"] for r in out}),
            "out_unique_currencies_24h": len({r["currency"] for r in out}),
            "out_unique_formats_24h": len({r["format"] for r in out}),
            "out_count_1h": len(hour), "out_sum_1h": sum(r["amount"] for r in hour),
            "in_count_24h": len(incoming), "in_sum_24h": sum(received),
            "in_mean_24h": sum(received) / len(received), "in_std_24h": deviation(received),
            "in_unique_src_24h": len({r["src"] for r in incoming}),
            "in_unique_banks_24h": len({r["fb"] for r in incoming}),
        }
    return expected


def random_rows(count, seed):
    """Half of all rows belong to one sender, a third to one receiver; many ties in time."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        base = rng.choice([0, 3600, 3601, DAY, DAY + 1, 2 * DAY, 5 * DAY, 6 * DAY])
        rows.append(
            {
                "s": base + rng.choice([0, 0, 1, 59, rng.randint(0, DAY)]),
                "src": "HOT" if rng.random() < 0.5 else f"S{rng.randint(1, 4)}",
                "dst": "SINK" if rng.random() < 0.33 else f"D{rng.randint(1, 6)}",
                "fb": rng.randint(1, 3), "tb": rng.randint(1, 4),
                "amount": rng.choice([5, 5.25, 1e9, 1e9 + 0.01, rng.randint(1, 10**6)]),
                "currency": rng.choice(["Euro", "Yen", "US Dollar"]),
                "format": rng.choice(["Cash", "Wire"]),
            }
        )
    return rows


@pytest.mark.parametrize("seed", [11, 12])
def test_features_match_brute_force(make_ledger, seed):
    rows = random_rows(160, seed)
    names = trailing.SENDER.columns() + trailing.RECEIVER.columns()
    found = build_features(make_ledger(rows)).select("txn_id", *names).collect()
    expected = brute_force(rows)
    assert len(found) == len(rows)
    for row in found:
        for name in names:
            want, got = expected[row.txn_id][name], float(row[name])
            assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-3), (row.txn_id, name)


def sender_side(make_ledger, rows):
    frame = add_row_features(make_ledger(rows))
    return trailing.add_trailing(frame, trailing.SENDER, frame)


def test_frame_edges(make_ledger):
    rows = [{"s": s, "amount": 10} for s in (0, DAY, DAY, DAY + 1, 2 * DAY + 2, 10 * DAY)]
    got = sender_side(make_ledger, rows).orderBy("txn_id").collect()
    # Exactly 86,400 s back is inside, 86,401 s is outside, peers of a second are inside.
    assert [r.out_count_24h for r in got] == [1, 3, 3, 3, 1, 1]
    assert [r.out_std_24h for r in got] == [0.0] * 6
    rows = [{"s": s} for s in (0, 3600, 3601, 7202)]
    got = sender_side(make_ledger, rows).orderBy("txn_id").collect()
    assert [r.out_count_1h for r in got] == [1, 2, 2, 1]


def test_deviation_of_close_large_amounts(make_ledger):
    rows = [{"s": 0, "amount": "300000000.01"}, {"s": 5, "amount": "300000000.03"}]
    got = sender_side(make_ledger, rows).orderBy("txn_id").collect()
    assert got[1].out_std_24h == pytest.approx(0.0141421356, abs=1e-9)


def test_huge_amounts_do_not_fail(make_ledger):
    rows = [{"s": i, "amount": "9999999999999999.9999"} for i in range(30)]
    rows += [{"s": 31, "amount": "1"}]
    last = sender_side(make_ledger, rows).orderBy("txn_id").collect()[-1]
    expected = statistics.stdev([1e16] * 30 + [1])
    assert last.out_count_24h == 31
    assert last.out_std_24h == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize(
    "amounts",
    [["0.0123", "0.0125"], ["0.0001", "0.0009"], ["0.0210", "0.0213", "0.0216"], ["0.0001", "1000000000000"]],
)
def test_deviation_of_small_amounts(make_ledger, amounts):
    rows = [{"s": at, "amount": amount} for at, amount in enumerate(amounts)]
    last = sender_side(make_ledger, rows).orderBy("txn_id").collect()[-1]
    assert last.out_std_24h == pytest.approx(statistics.stdev(map(float, amounts)), rel=1e-12)


def test_building_the_plan_runs_nothing(spark, make_ledger):
    ledger = make_ledger(random_rows(20, 3)).cache()
    status = spark.sparkContext.statusTracker()
    before = set(status.getJobIdsForGroup(None))
    build_features(ledger)
    assert set(status.getJobIdsForGroup(None)) == before


def test_a_recurring_value_changes_its_count_only_where_it_comes_and_goes(make_ledger):
    """Hourly rows over three days: the count moves at the first and behind the last row, and is
    handed to every bucket between."""
    rows = [{"s": DAY + 3600 * hour, "dst": "SAME"} for hour in range(72)]
    base = add_row_features(make_ledger(rows))
    side = trailing.SENDER.only(["out_unique_dst_24h"])
    assert trailing._distinct_events(base, side).count() <= 2 + 5
    found = trailing.add_trailing(base, side, base).select("out_unique_dst_24h").distinct().collect()
    assert [row[0] for row in found] == [1]


@pytest.mark.parametrize("column", trailing.SENDER.columns())
def test_a_side_gives_the_same_when_less_is_asked(make_ledger, column):
    base = add_row_features(make_ledger(random_rows(60, 3)))
    whole = trailing.add_trailing(base, trailing.SENDER, base).select("txn_id", column)
    some = trailing.add_trailing(base, trailing.SENDER.only([column]), base).select("txn_id", column)
    assert sorted(whole.collect()) == sorted(some.collect())


@pytest.mark.parametrize("name", ["x2_same_account", "x4_rule_flags"])
def test_rules_compute_only_what_they_read(spark, name):
    """No squares, and of the distinct counts only that of receiving banks."""
    query = registry.all_queries()[name](spark, "/root/testdata/sf0.001")
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "q4" not in plan
    assert "AS kind" not in plan or name == "x4_rule_flags"
    assert "payment_format" not in plan
