"""Every registered query against its SQL oracle, over whole tables."""

import pytest

from tablecare.plans.catalogue import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, database, name):
    assert compare(QUERIES[name](spark, SMALL), database, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
