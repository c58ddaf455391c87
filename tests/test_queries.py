from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import compare, connect
from obsweave.plans.catalog import QUERIES
from obsweave.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    state, n, _, note = compare(spark, con, name, SF)
    assert state == "ok" and note == "", note


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["validate_rows", "percentiles", "histogram", "decode_json", "rolling_mean"])
def test_no_python_inside_plans(spark, name):
    df = contract.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
