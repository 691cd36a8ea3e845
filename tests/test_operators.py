"""Validation, profiles, checks, schemas, merges: on small tables."""

import datetime as dt
import json

import pytest

from cairnbook.functions.columns import snake_case
from cairnbook.operators import checks, profile, rows, validate
from cairnbook.plans.metrics import metric
from cairnbook.sources.schema import ColumnSpec, Registry, common_fields, ddl, struct_type

TEXT = ColumnSpec("string", size=50)


def messages(spark, specs, *values):
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in specs))
    return {r.message for r in validate.messages(df, specs).collect()}


def test_strings(spark):
    specs = {"a": ColumnSpec("string", nullable=False, size=50), "b": ColumnSpec("string", nullable=False, size=50), "c": TEXT, "d": TEXT}
    assert messages(spark, specs, "", " ", "x" * 51, "a\x01b") == {
        "empty string values in a", "empty string values in b", "string length exceeds 50 in c", "invalid control characters in d",
    }


def test_trimming(spark):
    specs = {c: ColumnSpec("string", size=50, allow_control_chars=True) for c in "abc"}
    df = spark.createDataFrame([("  valid  ", "\tvalid\n", " \t valid \n ")], "a string, b string, c string")
    assert tuple(validate.validated(df, specs).first()) == ("valid",) * 3


def test_floats(spark):
    specs = {"a": ColumnSpec("Float32"), "b": ColumnSpec("Float32"), "c": ColumnSpec("Float64"), "d": ColumnSpec("Float64")}
    assert messages(spark, specs, "3.4e38", "3.5e38", "1.23e100", "Infinity") == {"invalid floating-point values in b", "invalid floating-point values in d"}


def test_unsigned(spark):
    specs = {"a": ColumnSpec("UInt8"), "b": ColumnSpec("UInt8"), "c": ColumnSpec("UInt16"), "d": ColumnSpec("UInt16"), "e": ColumnSpec("UInt8")}
    assert messages(spark, specs, "255", "256", "65535", "-1", "1.5") == {"outside UInt8 range in b", "outside UInt16 range in d", "outside UInt8 range in e"}


def test_booleans(spark):
    values = ["true", "TRUE", "1", "yes", "t", "y", "false", "FALSE", "0", "no", "f", "n"]
    specs = {f"b{i}": ColumnSpec("bool", nullable=False) for i in range(12)}
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in specs))
    assert list(validate.validated(df, specs).first()) == [True] * 6 + [False] * 6


@pytest.mark.parametrize("whole", [1, 3, 5, 7, 9, 11])
def test_decimals(spark, whole):
    spec = {"d": ColumnSpec("number", nullable=False, whole=whole, decimal=2)}
    assert not messages(spark, spec, "1" * whole + ".25")
    for bad in ("1" * (whole + 1), "1.234", "abc"):
        assert messages(spark, spec, bad) == {f"numeric value exceeds {whole}.2 format in d"}


def test_dates(spark):
    specs = {"d": ColumnSpec("date")}
    for bad in ("2024/01/01", "13-32-2024", "2024-13-01"):
        assert messages(spark, specs, bad) == {"invalid date values in d"}
    df = spark.createDataFrame([("01-31-2024",), ("2024-01-31",), (None,)], "d string")
    assert [r.d for r in validate.validated(df, specs).collect()] == [dt.date(2024, 1, 31)] * 2 + [None]


def test_unknown_missing_and_shared_columns(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    with pytest.raises(ValueError, match="not defined in schema: b"):
        validate.validated(df, {"a": TEXT})
    with pytest.raises(ValueError, match="Non-nullable field c is missing in DataFrame"):
        validate.validated(df.select("a"), {"a": TEXT, "c": ColumnSpec("date", nullable=False)})
    assert validate.validated(df.select("a"), {"a": TEXT, "c": ColumnSpec("date")}).dtypes == [("a", "string"), ("c", "date")]
    with pytest.raises(ValueError, match="declared differently"):
        validate.validated_together({"x": df.select("a"), "y": df.select("a")}, {"x": {"a": TEXT}, "y": {"a": ColumnSpec("date")}})


def test_two_tables_in_one_pass(spark):
    specs = {"x": {"k": TEXT, "own": ColumnSpec("string", nullable=False)}, "y": {"k": TEXT}}
    x = spark.createDataFrame([("1", "v")], "k string, own string")
    out = validate.validated_together({"x": x, "y": x.select("k")}, specs)
    assert out["x"].columns == ["k", "own"] and out["y"].columns == ["k"] and out["y"].count() == 1
    with pytest.raises(ValueError, match="null values in non-nullable field own"):
        validate.validated_together({"x": x.selectExpr("k", "cast(null as string) own"), "y": x.select("k")}, specs)


def test_imputation(spark):
    specs = {"n": ColumnSpec("number", whole=5, decimal=2, imputation=0), "b": ColumnSpec("bool", imputation=False), "s": TEXT}
    df = spark.createDataFrame([(None, None, None)], "n decimal(7,2), b boolean, s string")
    assert tuple(validate.imputed(df, specs).first()) == (0, False, None)


def stats(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return profile.profile(df).first(), {r.rule: r.value for r in profile.suspicious(profile.profile(df)).collect()}


def test_profile(spark):
    n, _ = stats(spark, [1, 2, 3, None, 5], "long")
    assert (n.total_count, n.null_count, n.distinct_count, n.min_value, n.max_value, n.median) == (5, 1, 5, "1", "5", 2.5)
    b, _ = stats(spark, [True, False, True, None, True], "boolean")
    assert (b.distinct_count, b.true_count, b.false_count) == (3, 3, 1)
    s, _ = stats(spark, ["A", "B", "A", None, "C"], "string")
    assert (s.distinct_count, s.max_length, s.empty_count) == (4, 1, 0)
    assert stats(spark, [True, None, None, None], "boolean")[1]["high_null_ratio"] == 0.75
    assert stats(spark, [True, True, True, False], "boolean")[1]["extreme_imbalance"] == 0.75
    assert stats(spark, [0] * 50 + [1000], "long")[0].extreme_count == 1
    assert stats(spark, [7, 7], "long")[0].extreme_count == 0
    assert stats(spark, [None], "string")[1] == {"high_null_ratio": 1.0}


def test_profile_history(spark, tmp_path):
    history = profile.History(tmp_path / "p" / "profile.json")
    assert history.load() == {}
    df = profile.profile(spark.createDataFrame([(1, "x")], "a int, b string"))
    history.append(df)
    history.append(df)
    assert {k: len(v) for k, v in history.load().items()} == {"a": 2, "b": 2}
    (tmp_path / "p" / "profile.json").write_text("{broken")
    assert history.load() == {}


def test_duplicates(spark):
    rows_ = [("A1", "2024-01-31", "f1"), ("A1", "2024-01-31", "f2"), ("A2", "2024-01-31", "f1")]
    df = spark.createDataFrame(rows_, "assetNumber string, reportingPeriodEndDate string, source_file string")
    (found,) = profile.duplicates(df).collect()
    assert (found.assetNumber, found["count"], found.source_files, found.is_cross_file) == ("A1", 2, ["f1", "f2"], True)
    profile.require_keys(df)
    with pytest.raises(ValueError, match="null values in key"):
        profile.require_keys(df.selectExpr("cast(null as string) assetNumber", "reportingPeriodEndDate"))


def test_row_checks(spark):
    df = spark.createDataFrame([("a", '{"x":1}'), ("a", "yes"), ("b", None)], "assetNumber string, property string")
    assert [r.assetNumber for r in validate.single_property(df).collect()] == ["a"]
    flags = spark.createDataFrame([("true",), ("NULL",), ("maybe",), (None,)], "f string")
    assert [r.f for r in validate.boolean_literals(flags, "f").collect()] == ["maybe"]
    assert {r.column_name: r.null_count for r in validate.required_nulls(df, ("assetNumber", "property")).collect()} == {"assetNumber": 0, "property": 1}


def test_checks_pass_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (None, None), (1, "y")], "a int, b string")
    assert checks.not_null(df, "a").count() == 1
    assert checks.unique(df, "a").collect() == [(1, 2)]
    assert checks.accepted_values(df, "b", ["x"]).count() == 1
    assert checks.relationships(df, "a", df.where("a = 2"), "a").count() == 2
    assert checks.accepted_range(df, "a", 1, 1).count() == 0 and checks.accepted_range(df, "a", 1, inclusive=False).count() == 2
    ranges = spark.createDataFrame([(1, 0, 5), (1, 4, 9), (1, 9, 12)], "k int, lo int, hi int")
    assert checks.exclusive_ranges(ranges, "lo", "hi", "k").count() == 1


def test_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, rows.merged(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError, match="does not have: w"):
        rows.merged(old, new.selectExpr("k", "v", "1 w"), ["k"])
    with pytest.raises(ValueError, match="missing: v"):
        rows.merged(old, new.select("k"), ["k"])
    with pytest.raises(ValueError, match="no primary key"):
        rows.merged(old, new, [])
    assert rows.merged(old, new.selectExpr("k", "v", "1 w"), ["k"], evolve=True).columns == ["k", "v", "w"]
    assert rows.since_latest(old, old.limit(0), "k").count() == 2 and rows.since_latest(old, old.where("k = 1"), "k").count() == 1


def test_names_and_ddl():
    assert snake_case("reportPeriodEndScheduledLoanBalanceAmount") == "report_period_end_scheduled_loan_bal_amt"
    assert snake_case("originalLoanAmount") == "original_loan_amt"
    assert snake_case("a" * 70) == "a" * 63
    text = ddl("loans", {"assetNumber": ColumnSpec("string", nullable=False, size=6, description="the loan's id"), "amountDue": ColumnSpec("number", whole=9, decimal=2)})
    assert "asset_num VARCHAR(6) NOT NULL" in text and "amount_due NUMERIC(11,2)" in text and "PRIMARY KEY (asset_num)" in text and "'the loan''s id'" in text
    with pytest.raises(ValueError):
        ColumnSpec("Float32").sql_type()


def test_registry(tmp_path):
    registry, specs = Registry(tmp_path), {"a": ColumnSpec("number", whole=9, decimal=2)}
    (tmp_path / "loan.json").write_text(json.dumps({"a": {"type": "date", "nullable": True}}))
    assert registry.load("loan")["a"].type == "date"
    for n in range(11):
        assert registry.save("loan", specs | {f"c{n}": TEXT}, note=str(n)) == n + 1
    assert registry.versions("loan")[-1] == 11 and "c10" in registry.load("loan") and "c1" in registry.load("loan", 2)
    assert [h["version"] for h in registry.history("loan")] == list(range(1, 12))
    assert str(struct_type(specs)["a"].dataType) == "DecimalType(11,2)"
    assert list(common_fields(specs, specs | {"b": TEXT})) == ["a"]


def test_metric_of_several_models():
    with pytest.raises(ValueError, match="several models"):
        metric(None, ["total_noi", "total_current_balance"])
