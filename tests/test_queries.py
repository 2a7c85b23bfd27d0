from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from scorebook.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
# No player of this small table has faced the minimum number of balls.
EMPTY_HERE = {"best_strike_rate"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    found = difference(spark, duck, contract.queries()[name], contract.oracle_sql()[name], FOLDER)
    assert found is None or (found == "no rows" and name in EMPTY_HERE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
