"""Filings from XML to stored tables, stored tables, streams, models in steps."""

import pytest
from pyspark.sql import functions as F

from cairnbook.plans.warehouse import Warehouse
from cairnbook.sources import filings, tables, testbook
from cairnbook.sources.schema import ColumnSpec
from cairnbook.streaming import arrivals

S = ColumnSpec("string")
LOAN = {
    "assetTypeNumber": S, "assetNumber": ColumnSpec("string", nullable=False, size=6), "company": ColumnSpec("string", nullable=False), "trust": ColumnSpec("string", nullable=False),
    "source_file": ColumnSpec("string", nullable=False), "reportingPeriodEndDate": ColumnSpec("date", nullable=False), "assetAddedIndicator": ColumnSpec("bool"),
    "originalLoanAmount": ColumnSpec("number", whole=9, decimal=2, imputation=0),
}
PROPERTY = {k: LOAN[k] for k in ("assetTypeNumber", "assetNumber", "reportingPeriodEndDate", "company", "trust", "source_file", "assetAddedIndicator")} | {
    "propertyNumber": ColumnSpec("string", nullable=False, size=3), "propertyCity": S, "is_reporting_date_imputed": ColumnSpec("bool", nullable=False, imputation=False),
}


def filing(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "".join(f"<assets>{''.join(f'<{k}>{v}</{k}>' for k, v in r.items())}</assets>" for r in rows)
    path.write_text(f'<?xml version="1.0"?><assetData xmlns="http://example.org/x">{body}</assetData>')


@pytest.fixture
def book(tmp_path):
    date = "01-31-2024"
    filing(
        tmp_path / "in" / "Acme" / "Trust 1" / "102" / "a.xml",
        {"assetNumber": "12", "reportingPeriodEndDate": date, "originalLoanAmount": "100.50", "assetAddedIndicator": "true"},
        {"assetNumber": "12-001", "property": "<propertyCity>Here</propertyCity>"},
        {"assetNumber": "12.2", "reportingPeriodEndDate": date, "property": "<propertyCity>There</propertyCity>"},
    )
    filing(tmp_path / "in" / "Acme" / "Trust 1" / "102" / "b.xml", {"assetNumber": "12", "reportingPeriodEndDate": "2024-01-31"}, {"assetNumber": "13", "reportingPeriodEndDate": "2024-01-31"})
    return tmp_path


def test_ingest(spark, book):
    out = str(book / "out")
    audit = filings.ingest(spark, str(book / "in"), out, LOAN, PROPERTY, history=str(book / "h.json"))
    assert (audit["new_loans"], audit["new_properties"], audit["duplicate_keys"]) == (2, 2, 1)
    loans = {r.assetNumber: r for r in spark.read.parquet(f"{out}/loans").collect()}
    assert loans["12"].source_file.endswith("b.xml") and loans["12"].trust == "Trust 1" and loans["12"].originalLoanAmount == 0
    props = {r.propertyNumber: r for r in spark.read.parquet(f"{out}/properties").collect()}
    assert props["001"].is_reporting_date_imputed and props["001"].reportingPeriodEndDate == props["002"].reportingPeriodEndDate and props["002"].propertyCity == "There"
    again = filings.ingest(spark, str(book / "in"), out, LOAN, PROPERTY)
    assert (again["new_loans"], again["new_properties"]) == (0, 0)
    filings.write_json(book / "audit.json", again)
    total = filings.summary(spark.createDataFrame([(2, 2, 1), (0, 0, 1)], "new_loans int, new_properties int, duplicate_keys int")).first()
    assert tuple(total) == (2, 2, 2, 2)


def test_ingest_rejects(spark, book):
    filing(book / "in" / "Acme" / "Trust 1" / "102" / "c.xml", {"assetNumber": "12345678", "reportingPeriodEndDate": "2024/01/31"})
    with pytest.raises(ValueError, match="invalid date values in reportingPeriodEndDate, string length exceeds 6 in assetNumber"):
        filings.ingest(spark, str(book / "in"), str(book / "out"), LOAN, PROPERTY)


def test_stored_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for trust in ("T 1", "T2"):
        tables.append(df, f"{tmp_path}/Acme/{trust}/loans")
    (tmp_path / "Acme" / "T3" / "loans").mkdir(parents=True)
    found = tables.datasets(spark, str(tmp_path), "loans")
    assert len(found) == 2
    both = tables.read_together(spark, found, "loans")
    assert {(r.company, r.trust) for r in both.collect()} == {("Acme", "T 1"), ("Acme", "T2")} and both.count() == 4
    assert tables.columns_of(df)[0] == ("k", "int", True)
    df.createOrReplaceTempView("t")
    assert list(tables.records(spark, "select * from t where k = 1")) == [{"k": 1, "v": "a"}]


def test_catalogue_table(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 1)], "k int, v string, m int")
    tables.save_table(df, "test_saved", f"{tmp_path}/t", partition=["m"], sort=["k"])
    try:
        assert spark.table("test_saved").count() == 2
        stats = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED test_saved").collect()}
        assert "2 rows" in stats["Statistics"]
    finally:
        spark.sql("DROP TABLE test_saved")


def test_upserts(spark, tmp_path):
    target = f"{tmp_path}/t"
    tables.upsert(spark, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, m int"), target, ["k"])
    out = tables.upsert(spark, spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, m int"), target, ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    parts = f"{tmp_path}/p"
    tables.append(out, parts, ["m"])
    tables.upsert_partitions(spark, spark.createDataFrame([(3, "e", 2)], "k int, v string, m int"), parts, ["k"], "m")
    assert sorted((r.k, r.v, r.m) for r in spark.read.parquet(parts).collect()) == [(1, "a", 1), (2, "c", 2), (3, "e", 2)]


def test_stream_equals_batch(spark, tmp_path):
    schema = "k int, v string, t int"
    for i, part in enumerate([[(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (3, "d", 2)], [(2, "old", 0)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    stream = arrivals.arriving(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, 1)
    arrivals.merge_stream(stream, f"{tmp_path}/out", ["k"], "t", f"{tmp_path}/cp").awaitTermination()
    assert sorted(map(tuple, arrivals.merged_table(spark, f"{tmp_path}/out").collect())) == [(1, "c", 2), (2, "b", 1), (3, "d", 2)]


def test_interrupted_upserts_lose_nothing(spark, tmp_path):
    row = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    for n, state in enumerate(("written", "moved", "unfinished")):
        t = tmp_path / f"t{n}"
        tables.upsert(spark, row((1, "a"), (2, "b")), str(t), ["k"])
        row((1, "a"), (2, "c")).write.parquet(f"{t}._next")
        if state != "written":  # the old table was moved away
            t.rename(f"{t}._old")
        if state == "unfinished":
            (tmp_path / f"t{n}._next" / "_SUCCESS").unlink()
        out = tables.upsert(spark, row((3, "d")), str(t), ["k"])
        assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "c" if state == "moved" else "b"), (3, "d")]
        assert sorted(p.name for p in tmp_path.glob(f"t{n}*")) == [t.name]


def test_changes_with_one_key_are_rejected(spark, tmp_path):
    row = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    tables.upsert(spark, row((1, "a"), (None, "n"), (None, "m")), f"{tmp_path}/t", ["k"])
    with pytest.raises(Exception, match="several changes with one key"):
        tables.upsert(spark, row((2, "x"), (2, "y")), f"{tmp_path}/t", ["k"])
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["a", "m", "n"]


def test_increments_equal_full_refresh(spark, folder, tmp_path):
    """A fact rebuilt for the keys that new months touch, then merged, is the fact of all months."""
    loans, props = testbook.loans(spark, folder).persist(), testbook.properties(spark, folder)
    keys, cut = ["loan_id", "reporting_date", "trust_id"], F.lit("1999-01-01").cast("date")
    early = loans.where(F.col("reporting_period_end_date") < cut)
    target = Warehouse(early, props)["fct_loan_monthly_performance"]
    touched = loans.where(F.col("reporting_period_end_date") >= cut).select(F.regexp_replace("asset_num", "A$", "").alias("base")).distinct()
    history = loans.withColumn("base", F.regexp_replace("asset_num", "A$", "")).join(touched, "base", "left_semi").drop("base")
    # attributes of trusts come from all loans
    changes = Warehouse(history, props)["fct_loan_monthly_performance"]
    from cairnbook.operators.rows import merged

    whole = Warehouse(loans, props)["fct_loan_monthly_performance"]
    assert merged(target, changes, keys).exceptAll(whole).isEmpty() and whole.exceptAll(merged(target, changes, keys)).isEmpty()


def test_materialised_models(spark, folder, tmp_path):
    w = Warehouse(testbook.loans(spark, folder), testbook.properties(spark, folder))
    n = w["fct_loan_monthly_performance"].count()
    assert w.materialise("fct_loan_monthly_performance", str(tmp_path), partition=True).count() == n
    assert w["loan_aging_metrics"].count() > 0
