"""Every registered query against its SQL over the same tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query(spark, sf, con, key):
    df = entry.queries()[key](spark, sf)
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
