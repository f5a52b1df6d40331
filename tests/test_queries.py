import pytest

from tests.comparing import same
from tidemark import queries

ORACLES = queries.oracle_sql()


def test_every_query_has_sql():
    assert set(queries.queries()) == set(ORACLES)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, small, name):
    same(queries.queries()[name](spark, small), ORACLES[name], small)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
