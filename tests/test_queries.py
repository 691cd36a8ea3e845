"""Every query with SQL gives the SQL's rows on the smallest tables."""

import pytest
from oracle import assert_equal, connect

from cairnbook.plans import queries, warehouse
from cairnbook.sources import testbook

NAMES = sorted(queries.ORACLE)


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, folder, connection, name):
    assert_equal(queries.QUERIES[name](spark, folder), connection, queries.ORACLE[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans(spark, folder):
    """One row per key limits groups before its shuffle; no query multiplies tables without a key."""
    plan = lambda name: queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan("q_distinct_on_loans")
    for name in ("m_portfolio_concentration", "m_loan_risk_metrics", "m_property_occupancy_noi"):
        assert "CartesianProduct" not in plan(name)
    assert "BroadcastHashJoin" in plan("m_delinquency_by_month_trust")


@pytest.mark.parametrize("name", ["m_dim_trust", "m_fct_loan_monthly_performance", "m_dim_property", "m_fct_property_metrics", "m_delinquency_by_month_trust"])
def test_trusts_beyond_the_bound_are_not_sent(spark, folder, connection, monkeypatch, name):
    """The same rows where the trusts are more than what may be sent."""
    few = warehouse.Warehouse(testbook.loans(spark, folder), testbook.properties(spark, folder))
    few.trusts()
    assert few.few_trusts
    monkeypatch.setattr(warehouse, "GROUPS_SENT", 1)
    many = warehouse.Warehouse(testbook.loans(spark, folder), testbook.properties(spark, folder))
    rows = many[name.removeprefix("m_")]
    assert not many.few_trusts
    assert_equal(rows, connection, queries.ORACLE[name])
