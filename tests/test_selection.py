"""Medians and distinct counts by counting, ranks by ranges, group averages: against plain Python and windows."""

import datetime
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cairnbook.operators import groups, profile, selection

INF, NAN = float("inf"), float("nan")
CASES = {
    "none": [None, None], "one": [7.0], "two": [1.0, 4.0], "ties": [2.0] * 50 + [3.0] * 50, "one value": [5.5] * 40,
    "even": [float(i) for i in range(1000)], "odd": [i * 0.25 for i in range(-500, 501)],
    "uneven": [10.0**i * s for i in range(-300, 300, 3) for s in (1, -1, 2)], "tiny": [0.0, 5e-324, 1e-323, 1.5e-323], "huge": [1.7e308, -1.7e308, 1.6e308, 0.5],
    "infinite": [INF, -INF, -INF, 1.0, 2.0], "only infinite": [INF, -INF, INF], "nan": [NAN, NAN, 1.0, None], "mixed": [random.Random(4).gauss(0, 1) ** 5 for _ in range(3001)],
}


def median(values):
    v = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), 0 if math.isnan(x) else x))
    if not v:
        return None
    place = (len(v) - 1) / 2
    a, b = v[math.floor(place)], v[math.ceil(place)]
    return a if a == b else a + (b - a) * (place - math.floor(place))


@pytest.mark.parametrize("ranges", [2048, 3])
def test_medians(spark, monkeypatch, ranges):
    monkeypatch.setattr(selection, "RANGES", ranges)
    names = list(CASES) if ranges > 3 else ["one", "two", "ties", "one value", "even", "odd", "infinite", "nan", "tiny"]
    longest = max(len(CASES[n]) for n in names)
    rows = [[CASES[n][i] if i < len(CASES[n]) else None for n in names] for i in range(longest)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(3)
    found = selection.medians(df, {n: F.col(f"`{n}`") for n in names})
    for n in names:
        assert found[n] == median(CASES[n]) or (math.isnan(found[n]) and math.isnan(median(CASES[n]))), n


def test_quantiles_and_types(spark):
    df = spark.range(11).select(F.col("id").cast("decimal(10,2)").alias("d"), F.col("id").cast("int").alias("i"))
    assert selection.medians(df, {"d": F.col("d"), "i": F.col("i")}, at=0.25) == {"d": 2.5, "i": 2.5}
    assert selection.medians(df.limit(0), {"d": F.col("d")}) == {"d": None} and selection.medians(df, {}) == {}


def test_distinct_counts(spark):
    rows = [(i % 7, f"t{i % 3}" if i % 5 else None, 0.0 if i % 2 else -0.0, datetime.date(2020, 1, 1 + i % 28), None) for i in range(500)]
    df = spark.createDataFrame(rows, "a.b int, s string, z double, d date, n string".replace("a.b", "`a.b`"))
    assert selection.distinct_counts(df, df.columns) == {"a.b": 7, "s": 3, "z": 1, "d": 28, "n": 0}
    assert selection.distinct_counts(df, []) == {}


def test_profile_of_odd_tables(spark):
    df = spark.createDataFrame([(1.0, "a", True, [1])], "x double, `s t` string, b boolean, l array<int>")
    none = {r.column_name: r for r in profile.profile(df.limit(0)).collect()}
    assert none["x"].total_count == 0 and none["x"].median is None and none["s t"].median_length is None
    one = {r.column_name: r for r in profile.profile(df).collect()}
    assert set(one) == {"x", "s t", "b"} and one["x"].median == 1.0 and one["x"].extreme_count == 0 and one["s t"].distinct_count == 1
    assert profile.profile(df.select("l")).collect() == []


def ranked_rows(spark):
    rng = random.Random(2)
    value = lambda i: None if i % 11 == 0 else 5.0 if i % 3 == 0 else round(rng.gauss(0, 30), 1)
    rows = [("big" if i % 4 else None if i % 8 else f"small{i % 5}", i % 2, value(i), i) for i in range(3000)] + [("lone", 0, 1.0, -1), ("empty", 0, None, -2), ("empty", 0, None, -3)]
    return spark.createDataFrame(rows, "g string, h int, v double, id long").repartition(6)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_first", [False, True])
@pytest.mark.parametrize("known", [None, 12])
def test_ranks_equal_a_window(spark, descending, nulls_first, known):
    rows = ranked_rows(spark)
    order = getattr(F.col("v"), f"{'desc' if descending else 'asc'}_nulls_{'first' if nulls_first else 'last'}")()
    w = Window.partitionBy("g", "h").orderBy(order)
    want = rows.withColumn("rank", F.rank().over(w).cast("long")).withColumn("p", F.percent_rank().over(w))
    got = groups.with_rank(rows, ["g", "h"], "v", percent="p", descending=descending, nulls_first=nulls_first, groups=known, ranges=8)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_frequent_value_is_several_tasks(spark):
    """Rows of one value are dealt to several parts, and the plan sorts none by the group alone."""
    rows = spark.range(4000).select(F.lit("g").alias("g"), F.lit(1).alias("v"), "id")
    assert groups.with_rank(rows, ["g"], "v").select("rank").distinct().collect()[0].rank == 1
    plan = groups.with_rank(rows, ["g"], "v", groups=1)._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("Window")[1]


@pytest.mark.parametrize("known", [None, 30])
def test_group_means_equal_a_window(spark, known):
    rows = ranked_rows(spark)
    w = Window.partitionBy("g", "h")
    want = rows.withColumn("m", F.round(F.avg("v").over(w), 9)).withColumn("n", F.round(F.avg(F.col("id") * 2).over(w), 9))
    got = groups.with_group_means(rows, ["g", "h"], {"m": F.col("v"), "n": F.col("id") * 2}, known)
    got = got.withColumns({c: F.round(c, 9) for c in "mn"})
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = groups.with_group_means(rows, ["g"], {"m": F.col("v")}, 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan
