from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.ordering import (
    approximate_time_quantile,
    global_row_number,
    running_total,
    time_quantile,
)


def test_global_row_number_matches_a_sort(spark):
    rows = [(i, random.Random(i).randint(0, 20)) for i in range(500)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(7)
    ranked = global_row_number(frame, [F.col("v").desc(), F.col("k").asc()], "place")
    got = {r.k: r.place for r in ranked.collect()}
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {k: i for i, (k, _) in enumerate(expected, start=1)}


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_running_total_matches_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(g, k, rng.randint(0, 9)) for g in "ab" for k in rng.sample(range(100), 40)]
    frame = spark.createDataFrame(rows, "g string, k int, v int")
    got = running_total(frame, ["g"], "k", "v", "upto", "total", block).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.upto == sum(v for g, k, v in rows if g == row.g and k <= row.k)
        assert row.total == sum(v for g, k, v in rows if g == row.g)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.8, 0.9, 1.0])
def test_time_quantile_is_the_discrete_one(spark, fraction):
    rng = random.Random(9)
    seconds = sorted(rng.choice([rng.randint(0, 400_000), 86400, 5]) for _ in range(300))
    frame = spark.createDataFrame([(s,) for s in seconds], "ts_unix bigint")
    expected = next(s for i, s in enumerate(seconds) if sum(x <= s for x in seconds) / 300 >= fraction)
    assert time_quantile(frame, "ts_unix", fraction) == expected
    assert abs(approximate_time_quantile(frame, "ts_unix", fraction) - expected) <= 400_000


def test_time_quantile_of_nothing(spark):
    assert time_quantile(spark.createDataFrame([], "ts_unix bigint"), "ts_unix", 0.5) is None
