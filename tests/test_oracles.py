"""Every registered query against its SQL counterpart, names, types and values included."""

import __spark_entry__ as contract
import pytest
from compare import connect, differences

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    found = QUERIES[name](spark, sf)
    if name in ORACLES:
        problem = differences(found, duck, ORACLES[name])
        assert not problem, problem
    else:
        assert found.columns


def test_entry(spark):
    assert contract.entry(spark).count() > 0
