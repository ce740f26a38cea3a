"""Every registered query gives what its SQL gives."""

import pytest
from conftest import SF, same

from tidewarden.queries import QUERIES, SQL


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    same(QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
