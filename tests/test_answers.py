"""Every registered query against its SQL answer, on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF_TINY

import __spark_entry__ as entry_points
from ledgerlens import registry
from oracle import answers
from oracle.compare import check, connect

QUERIES = registry.all_queries()
ANSWERS = answers()


@pytest.fixture(scope="module")
def connection():
    with connect(SF_TINY) as opened:
        yield opened


def test_answers_belong_to_queries():
    assert set(ANSWERS) <= set(QUERIES)
    core = set(registry.all_queries())
    assert core - set(ANSWERS) == {"e1_logistic_headline", "e1_trees_headline"}


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_query_equals_sql(spark, connection, name):
    equal, note, _ = check(spark, SF_TINY, QUERIES[name], ANSWERS[name], connection)
    assert equal, note


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
