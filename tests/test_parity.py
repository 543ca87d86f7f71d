"""Every registered query equals its oracle SQL."""

import os

import pytest

import __spark_entry__ as contract
from peerscore.plans.oracle import ORACLE
from peerscore.plans.queries import QUERIES
from tests.parity import connect, oracle_rows, spark_rows

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_parity(spark, oracle, name):
    expected = oracle_rows(oracle, contract.oracle_sql()[name])
    found = spark_rows(contract.queries()[name](spark, SF_DIR))
    assert found[0] == expected[0]
    assert found[1] == expected[1]


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
