"""Every query against its SQL."""

import pytest

import __spark_entry__ as e
from check_oracles import connect, difference
from conftest import SMALL

SQL = e.oracle_sql()
QUERIES = e.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, con, key):
    assert difference(QUERIES[key](spark, SMALL), con.sql(SQL[key])) == ""


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, key):
    assert QUERIES[key](spark, SMALL).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = e.entry(spark)
    assert df.columns == ["periodo", "tipo_movimiento", "movimientos", "monto_total"]
    assert df.count() > 0
