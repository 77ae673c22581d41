"""Every registered query against its SQL twin, and what its plan must not contain."""

import pytest

import __spark_entry__ as entry
from basketlens import catalog, oracle
from tests.conftest import SF_DIR
from tests.oracle_compare import compare, connect

QUERIES, SQL = dict(catalog.QUERIES), dict(oracle.SQL)


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR).toPandas(), connection.sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


FITS = ("forecast_xg_fixed", "forecast_gb_fixed")  # minutes of fitting before there is a plan


@pytest.mark.parametrize("name", sorted(SQL.keys() - set(FITS)))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "RFM_LABEL" in rows.columns
