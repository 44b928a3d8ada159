"""Every registered query against its SQL statement, on whole tables."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences

from breakwater.plans.oracle import statements
from breakwater.plans.queries import registry

QUERIES = registry()
SQL = statements()


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck, small_dir):
    assert differences(QUERIES[name](spark, small_dir), duck, SQL[name]) is None


def test_entry_returns_breaks(spark):
    assert entry_point.entry(spark).count() == 568
