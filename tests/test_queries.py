import pytest

from downfield import queries

from .compare import assert_same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, data, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLES[name], data)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
