"""Rows that are dealt by their asset's home: once, and with the results of plain joins."""

import re

import pytest
from pyspark.sql import functions as F

from cairnbook.functions.columns import home
from cairnbook.operators.groups import with_group_means
from cairnbook.operators.rows import as_of_versions
from cairnbook.plans import queries, warehouse
from cairnbook.plans.metrics import metric
from cairnbook.sources import testbook


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (hash|range)partitioning", plan(df)))


def dealt(df):
    """By what rows are dealt in parts that grow with the tables, and what they hold then."""
    return re.findall(r"Exchange hashpartitioning\((.*), \d+\), REPARTITION_BY_NUM.*\n\W*\d* *\W*Project \[(.*)\]", re.sub(r"#\d+L?", "", plan(df)))


def scans(df, first):
    return re.findall(rf"FileScan parquet \[{first}.*?\]", plan(df))


@pytest.mark.parametrize("name", ["m_int_properties_cleaned", "m_fct_property_metrics", "m_dim_property"])
def test_property_rows_are_shuffled_once(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    assert shuffles(df) == 2  # lines while they are narrow, and customers
    assert len(scans(df, "l_orderkey")) == 1  # no second pass for split-note rows


def test_loans_and_properties_meet_without_a_shuffle(spark, folder):
    """Lines, customers and loans by home, and the mart's groups."""
    assert shuffles(queries.QUERIES["m_loan_risk_metrics"](spark, folder)) == 4


def test_sums_by_type_are_made_in_one_pass(spark, folder):
    df = queries.QUERIES["m_property_by_type"](spark, folder)
    assert shuffles(df) == 3 and len(scans(df, "l_orderkey")) == 1


def test_ranks_read_counted_categories(spark, folder):
    assert not scans(queries.QUERIES["m_portfolio_concentration_fixed"](spark, folder), "l_orderkey")


def test_performance_shuffles_only_lines_customers_and_loans(spark, folder, monkeypatch):
    """The rows that are stored, before averages: lines, customers and loans by home."""
    stored = []
    monkeypatch.setattr(warehouse, "kept", lambda df, name: stored.append(df) or df)
    queries.QUERIES["m_property_performance_metrics"](spark, folder)
    assert shuffles(stored[0]) == 3


@pytest.mark.parametrize("name", ["metric_declining_occupancy_properties_pct", "metric_distressed_properties_pct"])
def test_metrics_without_type_averages_store_no_rows(spark, folder, monkeypatch, name):
    """And carry no values that they don't need: narrow rows are sorted."""
    stored = []
    monkeypatch.setattr(warehouse, "kept", lambda df, name: stored.append(name) or df)
    df = queries.QUERIES[name](spark, folder)
    assert not stored and not re.search("tenant|year_built|_address_|maturity", plan(df))
    assert shuffles(df) == 4  # lines, customers and loans by home, and the metric's groups


def test_metrics_by_type_averages_have_them(spark, folder):
    w = queries.warehouse(spark, folder)
    names = ["declining_occupancy_properties_pct", "average_property_risk_score"]
    for by, where in ((["Occupancy_VS_Type"], None), (["reporting_date"], "type_avg_dscr > 1.4")):
        found = metric(queries.warehouse(spark, folder), names, by, where).collect()
        whole = w["property_performance_metrics"]
        assert sorted(map(repr, found)) == sorted(map(repr, metric(w, names, by, where).collect())) and 0 < len(found) <= whole.select(*by).distinct().count()


@pytest.mark.parametrize("name", ["metric_herfindahl_index", "metric_pct_of_balance", "metric_top_property_type_concentration"])
def test_shares_carry_no_values_of_months(spark, folder, monkeypatch, name):
    """The rows that are counted: of split notes and their bases too, only what places, types and balances need."""
    stored = []
    monkeypatch.setattr(warehouse, "kept", lambda df, name: stored.append(df) or df)
    queries.QUERIES[name](spark, folder)
    assert shuffles(stored[0]) == 4 and not re.search("tenant|valuation|occupancy|revenue|expenses|payment_frequency", plan(stored[0]))


def test_lines_are_dealt_as_numbers(spark, folder):
    """A task holds what it deals in memory: no text, not even the home that it is dealt by."""
    rows = dict(dealt(queries.QUERIES["metric_distressed_properties_pct"](spark, folder)))
    assert rows["cast(c as string)"] == "c, half, d, l_orderkey, l_partkey"


@pytest.mark.parametrize("name", ["metric_herfindahl_index", "metric_pct_of_balance", "metric_top_property_type_concentration"])
def test_loans_are_dealt_as_numbers(spark, folder, monkeypatch, name):
    """Names, files and numbers of assets are made behind."""
    stored = []
    monkeypatch.setattr(warehouse, "kept", lambda df, name: stored.append(df) or df)
    queries.QUERIES[name](spark, folder)
    rows = dict(dealt(stored[0]))
    assert rows["cast(o_custkey as string)"] == "o_orderkey, o_custkey, o_orderdate, o_totalprice, c_nationkey"


@pytest.mark.parametrize("name", ["metric_pct_of_balance", "metric_top_property_type_concentration"])
def test_joins_with_orders_have_parts_that_grow_with_the_tables(spark, folder, monkeypatch, name):
    """A task sorts both sides and holds what it deals: Spark's own parts, by what is on disk, are more than that."""
    stored = []
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    usual = sorted(map(repr, queries.QUERIES[name](spark, folder).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(testbook, "LINES", 50)
        dealt = sorted(map(repr, queries.QUERIES[name](spark, folder).collect()))
        monkeypatch.setattr(warehouse, "kept", lambda df, name: stored.append(df) or df)
        queries.QUERIES[name](spark, folder)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = dict(re.findall(r"Exchange hashpartitioning\((\w+), (\d+)\)", re.sub(r"#\d+L?", "", plan(stored[0]))))
    n = -(-lines // 600)
    assert all(int(found[k]) == n > 4 for k in ("l_orderkey", "o_orderkey", "o_custkey", "c_custkey")) and dealt == usual


def test_dealt_loans_are_the_loans(spark, folder):
    loans, rows = testbook.loans(spark, folder), testbook.loans(spark, folder, 7)
    assert rows.columns == [*loans.columns, "_base"] and not rows.where(~F.col("_base").eqNullSafe(home("asset_num"))).count()
    assert rows.rdd.getNumPartitions() == 7 and sorted(map(repr, rows.drop("_base").collect())) == sorted(map(repr, loans.collect()))


@pytest.mark.parametrize("name", ["property_performance_metrics", "property_performance_fixed"])
def test_lean_rows_are_the_models_rows(spark, folder, name):
    lean = queries.warehouse(spark, folder).rows(name, "noi_trend")
    whole = queries.warehouse(spark, folder)[name]
    assert {c for c in whole.columns if c not in lean.columns} == {c for c in whole.columns if c.startswith("type_avg_") or c.endswith("_vs_type")}
    assert sorted(map(repr, lean.collect())) == sorted(map(repr, whole.select(*lean.columns).collect()))


def test_homes_imply_no_other_rows(spark):
    """Numbers with '_' and 'A's, nulls, and versions whose ends are not in."""
    keys = ["1", "1A", "1AA", "1_2", "1A_2", "A", "", "a_b_c", None]
    facts = spark.createDataFrame([(k, d) for k in keys for d in range(6)], "key string, at int").withColumn("h", home("key"))
    versions = spark.createDataFrame([(k, a, a + 2) for k in keys for a in (1, 3)], "key string, effective_date int, end_date int").withColumn("h", home("key"))
    for how in ("inner", "left"):
        plain = as_of_versions(facts, versions.drop("h"), "key", "at", how).collect()
        dealt = as_of_versions(facts, versions, "key", "at", how, home="h").collect()
        assert sorted(map(repr, plain)) == sorted(map(repr, dealt))
    assert {r.key: r.h for r in facts.collect()} == {"1": "1", "1A": "1", "1AA": "1", "1_2": "1", "1A_2": "1", "A": "", "": "", "a_b_c": "a", None: None}


def test_group_means_are_rounded_once_a_group(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), (None, 5.0)], "g string, v double")
    found = with_group_means(rows, ["g"], {"m": F.col("v")}, 2, 3)
    assert {(r.g, r.m) for r in found.collect()} == {("a", 1.333), (None, 5.0)}
