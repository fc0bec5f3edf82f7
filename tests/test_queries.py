"""Every named query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from check import both, duck
from clickloom.plans import registry

# What no query's plan may hold: all pairs of rows, rows sent to Python, aggregation by sorting.
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SortAggregate")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_each_query_has_sql():
    assert set(registry.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, con, plan, name):
    df = contract.queries()[name](spark, SF_DIR)
    ours, theirs = both(df, con, contract.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert len(ours[1]) > 0
    assert ours[1] == theirs[1]
    assert not [slow for slow in SLOW if slow in plan(df, run=False)]


def test_entry(spark):
    assert contract.entry(spark).columns == ["category_id", "session_id", "click_count"]
