"""Every registered query against its SQL, and what SQL cannot say by brute force."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect


# The queries of an added subpackage are tested beside it.
CORE = sorted(name for name, fn in entry.queries().items() if fn.__module__.startswith("tablebridge.queries."))


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_result_check():
    without = set(CORE) - set(entry.oracle_sql())
    assert not without


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CORE)
def test_query(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) == ""
