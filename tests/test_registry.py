"""Every named query against its SQL, on the smallest folder."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from tidelake.registry.oracle import ORACLE
from tidelake.registry.queries import QUERIES

@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, db, small, name):
    assert compare(spark, db, entry.queries()[name], entry.oracle_sql()[name], small) == ""


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["order_date", "category", "total_revenue", "order_count"] and not rows.isEmpty()
