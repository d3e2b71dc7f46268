"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallyspan.registry.queries import REGISTRY
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_oracle(spark, duck, name):
    found = differences(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name])
    assert found == []


def test_comparison_sees_a_wrong_value(spark, duck):
    wrong = contract.oracle_sql()["mart"].replace("SELECT * FROM mart", "SELECT * FROM mart WHERE type <> 'SIM'")
    assert differences(contract.queries()["mart"](spark, SF_DIR), duck, wrong)


def test_entry(spark):
    assert contract.entry(spark).columns[:2] == ["date", "type"]
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())
