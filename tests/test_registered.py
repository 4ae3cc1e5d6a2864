"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
import compare

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_each_query_has_sql():
    assert set(QUERIES) - set(contract.TEXT_QUERIES) == set(SQL) - set(contract.TEXT_SQL)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[:3] == ["location", "license_plate", "current_status"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(contract.TEXT_QUERIES)))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []
