"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import difference, duck_connection
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)


def test_contract(spark):
    assert set(entry_point.queries()) >= set(QUERIES)
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, name) is None
