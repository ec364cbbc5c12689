"""Every query against its SQL on the small tables."""

import pytest

import compare
from spokeline.verification import oracle, registry

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_sql(spark, db, name):
    assert compare.differences(registry.queries()[name](spark, SF), db, oracle.oracle_sql()[name]) == []
