from __future__ import annotations

import random

import pytest

from ledgerlens.operators.components import account_graph, connected_components
from ledgerlens.plans import accounts

DAY = 86400


def gaps_by_definition(rows):
    events = {}
    for number, row in enumerate(rows, start=1):
        flag = row.get("flag", 0)
        events.setdefault(row["dst"], []).append((row["s"], "in", number, flag))
        events.setdefault(row["src"], []).append((row["s"], "out", number, flag))
    found = []
    for history in events.values():
        history.sort()
        for before, now in zip(history, history[1:]):
            if before[1] == "in" and now[1] == "out":
                found.append((now[3], now[0] - before[0]))
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_pass_through_matches_definition(make_ledger, seed):
    rng = random.Random(seed)
    names = ["HOT", "A", "B", "C"]
    rows = [
        {
            "s": rng.choice([0, 1, DAY - 1, DAY, 3 * DAY]) + rng.choice([0, 0, 7, rng.randint(0, DAY)]),
            "src": rng.choice(names), "dst": rng.choice(names), "flag": rng.randint(0, 1),
        }
        for _ in range(80)
    ]
    got = sorted((r.is_laundering, r.gap_sec) for r in accounts.pass_through_gaps(make_ledger(rows)).collect())
    assert got == gaps_by_definition(rows)


@pytest.mark.parametrize(
    "gap,decade", [(0, -1), (1, 0), (59, 0), (60, 1), (3599, 1), (3600, 2), (86400, 3), (604800, 4)]
)
def test_gap_decades(make_ledger, gap, decade):
    rows = [{"s": 100, "src": "X", "dst": "M"}, {"s": 100 + gap, "src": "M", "dst": "Y"}]
    got = accounts.pass_through_histogram(make_ledger(rows)).collect()
    assert [(r.is_laundering, r.decade, r.n) for r in got] == [(0, decade, 1)]


def test_out_before_in_is_no_pass_through(make_ledger):
    rows = [{"s": 0, "src": "M", "dst": "Y"}, {"s": 9, "src": "X", "dst": "M"}]
    assert accounts.pass_through_gaps(make_ledger(rows)).count() == 0


def sizes(spark, edges):
    frame = spark.createDataFrame(edges, "from_account string, to_account string")
    vertices, links = account_graph(frame)
    found = connected_components(vertices, links).collect()
    groups = {}
    for row in found:
        groups.setdefault(row.component, set()).add(row.id)
    assert all(component == min(members) for component, members in groups.items())
    return sorted(len(members) for members in groups.values())


def test_components_chain(spark):
    assert sizes(spark, [(f"v{i:03d}", f"v{i + 1:03d}") for i in range(49)]) == [50]


def test_components_star_cliques_loop(spark):
    star = [("hub", f"leaf{i}") for i in range(40)] + [("leaf3", "hub")]
    cliques = [(f"{c}{i}", f"{c}{j}") for c in "pq" for i in range(5) for j in range(5) if i != j]
    assert sizes(spark, star + cliques + [("alone", "alone")]) == [1, 5, 5, 41]


def test_components_random_against_union_find(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randint(0, 150)}", f"n{rng.randint(0, 150)}") for _ in range(110)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    counts = {}
    for x in list(parent):
        counts[find(x)] = counts.get(find(x), 0) + 1
    assert sizes(spark, edges) == sorted(counts.values())


def test_degrees_of_one_sided_accounts(make_ledger):
    ledger = make_ledger([{"src": "A", "dst": "B", "flag": 1}, {"src": "A", "dst": "A"}])
    got = {r.account: (r.out_deg, r.in_deg, r.ever_laundering) for r in accounts.account_degrees(ledger).collect()}
    assert got == {"A": (2, 1, 1), "B": (0, 1, 1)}
    by_side = {(r.direction, r.ever_laundering, r.deg): r.n_accounts for r in accounts.degree_histogram(ledger).collect()}
    assert by_side == {("out", 1, 2): 1, ("in", 0, 1): 1, ("in", 1, 1): 1}
