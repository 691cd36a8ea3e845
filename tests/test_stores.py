"""Listings over pages, numbering, the raw store, clustered tables, a database."""

import random

import pytest
from pyspark.sql import functions as F

from cairnbook.operators.rows import aligned, numbered
from cairnbook.sources import clustering, listings, tables
from cairnbook.sources.rawstore import RawStore


def page(*rows, head=("A", "B"), onward=None, cls="tableFile2", rows_a_page=100):
    cells = "".join("<TR>" + "".join(f"<td class=x>{c}</td>" for c in r) + "</TR>" for r in rows)
    link = f'<input type="button" value="Next {rows_a_page}" onClick="parent.location=\'{onward}\'">' if onward else ""
    return f"<p>x</p><table class=\"{cls}\"><tr>{''.join(f'<th>{h}</th>' for h in head)}</tr>{cells}</table>{link}<table class='tableFile2'></table>"


PAGES = {
    "a0": page((" 1 ", "x&amp;<b>y</b>"), ("2", "first<br/>second"), onward="a1"),
    "a1": page(("z", "3", "q"), head=("C", " A\n", "<i>B</i>"), onward="a2", cls="wide tableFile2"),
    "a2": page(("4", "w"), head=("A", "C"), onward="a3"),  # lacks a column: the listing ends before it
    "a3": page(("5", "w")),
    "b0": page(("6", "v"), onward="b1"),
    "b1": page(("7", "u"), ("8",), onward="b0"),  # a circle, and a row that is too short
    "c0": page(("9", "t"), cls="other"),
    "d0": page(("10", "s"), onward="nowhere"),
    "e0": None,
    "f0": "<table class='tableFile2'>",
}


def test_listings(spark):
    pages = spark.createDataFrame([*PAGES.items(), ("a0", page(("0", "longer")) * 2), (None, "x")], "url string, html string")
    starts = spark.createDataFrame([(u[0], u) for u in PAGES if u.endswith("0")] + [("a again", "a0"), ("gone", "g0")], "listing string, url string")
    found = sorted((r.listing, r.page, r.row, *r.texts) for r in listings.listed(pages.where("html is null or length(html) < 500"), starts, ["B", "A"]).collect())
    a = [(0, 0, "x&y", "1"), (0, 1, "first", "2"), (1, 0, "q", "3")]
    b = [("b", 0, 0, "v", "6"), ("b", 1, 0, "u", "7"), ("b", 1, 1, None, "8")]
    assert found == sorted([*(("a", *x) for x in a), *(("a again", *x) for x in a), *b, ("d", 0, 0, "s", "10")])


@pytest.mark.parametrize("limit", [1, 2, 5, 8, 100, None])
def test_long_listings(spark, limit):
    links = [(f"u{i}", f"u{i + 1}" if i < 36 else None) for i in range(37)] + [("c0", "c1"), ("c1", "c2"), ("c2", "c1")]
    links = spark.createDataFrame(links, "url string, next_url string")
    starts = spark.createDataFrame([("u", "u0"), ("mid", "u30"), ("c", "c0"), ("none", "v")], "listing string, url string")
    got = sorted((r.listing, r.url, r.page) for r in listings.followed(starts, links, limit).collect())
    want = [("u", f"u{i}", i) for i in range(37)] + [("mid", f"u{30 + i}", i) for i in range(7)] + [("c", f"c{i}", i) for i in range(3)]
    assert got == sorted(x for x in want if limit is None or x[2] < limit)


def test_numbers_and_alignment(spark):
    values = [random.Random(5).randrange(50) for _ in range(900)]
    df = spark.createDataFrame([(v, i, "n") for i, v in enumerate(values)], "v int, id int, _old string").repartition(7)
    got = [(r.number, r.v, r.id) for r in numbered(df, [F.desc("v"), F.col("id")]).collect()]
    assert sorted(got) == [(n, v, i) for n, (v, i) in enumerate(sorted(((v, i) for i, v in enumerate(values)), key=lambda x: (-x[0], x[1])))]
    both = numbered(df.drop("_old"), [F.col("id")])
    chosen = both.select("number", "v").where("v % 3 = 0")
    out = sorted((r.number, r.id, r.v) for r in aligned(both.select("number", "id"), chosen).collect())
    assert out == [(n, i, v) for n, (i, v) in enumerate((i, v) for i, v in enumerate(values) if v % 3 == 0)]
    assert numbered(df.limit(0), [F.col("id")]).collect() == []
    same = numbered(spark.range(100).select(F.lit(1).alias("x")), [F.col("x")])
    assert sorted(r.number for r in same.collect()) == list(range(100))


def files(spark, **contents):
    return spark.createDataFrame([(k, None if v is None else v.encode()) for k, v in contents.items()], "key string, content binary")


def test_raw_store(spark, tmp_path):
    store = RawStore(spark, f"file://{tmp_path}/raw")
    assert store.read().collect() == [] and store.save(files(spark, none=None)) == 0 and store.table.versions() == []
    assert store.save(files(spark, a="one", b="two", c="one", d=None)) == 3
    first = sorted(x.name for x in (tmp_path / "raw").rglob("*") if x.is_file())
    # a second run writes nothing, even where contents are other ones now
    assert store.save(files(spark, a="changed", b="two", c="one")) == 0
    assert sorted(x.name for x in (tmp_path / "raw").rglob("*") if x.is_file()) == first
    assert store.save(files(spark, e="two", f="three", a="x")) == 2
    assert sorted((r.key, bytes(r.content).decode(), r.n_bytes) for r in store.read().collect()) == [("a", "one", 3), ("b", "two", 3), ("c", "one", 3), ("e", "two", 3), ("f", "three", 5)]
    contents = spark.read.parquet(*(str(p) for p in (tmp_path / "raw" / "content").iterdir()))
    assert contents.count() == 3  # equal contents are stored once
    wanted = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "key string")
    assert [r.key for r in store.missing(wanted).collect()] == ["z"]


def test_raw_store_of_repeated_rows(spark, tmp_path, monkeypatch):
    from cairnbook.sources import rawstore

    rows = spark.createDataFrame([(k, c.encode()) for k, c in (("a", "x"), ("a", "x"), ("b", "x"), ("c", "y"), ("c", "z"), ("d", "w"), ("d", "w"))], "key string, content binary").repartition(4)
    for n, most in enumerate((rawstore.KEYS_SENT, 0)):
        monkeypatch.setattr(rawstore, "KEYS_SENT", most)
        store = RawStore(spark, f"file://{tmp_path}/raw{n}")
        assert store.save(rows) == 4
        got = sorted((r.key, bytes(r.content).decode()) for r in store.read().collect())
        assert [k for k, _ in got] == ["a", "b", "c", "d"] and dict(got)["a"] == dict(got)["b"] == "x" and dict(got)["c"] in "yz" and dict(got)["d"] == "w"


def test_a_raw_store_run_that_dies(spark, tmp_path, monkeypatch):
    store = RawStore(spark, f"file://{tmp_path}/raw")
    store.save(files(spark, a="one"))

    def dies(rows):
        raise OSError("gone")

    monkeypatch.setattr(store.table, "upsert", dies)
    with pytest.raises(OSError, match="gone"):
        store.save(files(spark, a="one", b="two"))
    monkeypatch.undo()
    assert [r.key for r in store.read().collect()] == ["a"]
    assert store.save(files(spark, b="two")) == 1
    assert sorted((r.key, bytes(r.content)) for r in store.read().collect()) == [("a", b"one"), ("b", b"two")]


def test_clustered_tables_skip_files(spark, folder, tmp_path):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    at = f"file://{tmp_path}/z"
    clustering.write_clustered(rows, at, ["l_orderkey", "l_extendedprice"], 64)
    ends = {k: rows.select(F.percentile_approx(k, [0.45, 0.55])).first()[0] for k in ("l_orderkey", "l_extendedprice")}
    for ranges in ({"l_orderkey": tuple(ends["l_orderkey"])}, {"l_extendedprice": tuple(ends["l_extendedprice"])}, {k: tuple(v) for k, v in ends.items()}):
        hit, whole = clustering.files_of(spark, at, ranges)
        # the middle tenth of either key alone needs a third of the files at most, of both a seventh: the curve jumps there
        assert whole >= 48 and len(hit) <= whole * (0.34 if len(ranges) == 1 else 0.15)
        found, want = clustering.read_ranges(spark, at, ranges), rows
        for k, (low, high) in ranges.items():
            want = want.where(F.col(k).between(low, high))
        assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty() and want.count() > 0
        assert len(found.inputFiles()) == len(hit)
    assert clustering.read_ranges(spark, at, {"l_orderkey": (-5, -1)}).count() == 0


def test_clustered_odd_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None if i % 9 == 0 else 1.0 if i % 3 else float(i), i) for i in range(500)], "x double, i int")
    clustering.write_clustered(rows, f"file://{tmp_path}/z", ["x", "i"], 8)
    assert clustering.read_ranges(spark, f"file://{tmp_path}/z", {"x": (1.0, 1.0)}).count() == rows.where("x = 1").count()
    assert clustering.files_of(spark, f"file://{tmp_path}/z", {})[1] > 1
    with pytest.raises(ValueError, match="more than 62"):
        clustering.curve(rows, ["x", "i"], "z", 40)
    pairs = spark.createDataFrame([(0b1010, 0b0110)], "a int, b int").select(clustering.interleaved([F.col("a"), F.col("b")], 4)).first()
    assert pairs[0] == 0b10011100


def test_database(spark, folder):
    """Against the database that Spark's own jars include, in memory."""
    url, driver = "jdbc:derby:memory:cairnbook;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    tables.jdbc_append(rows.where("o_orderkey % 2 = 0"), url, "orders", **driver)
    whole = tables.jdbc_query(spark, url, "SELECT * FROM orders", split="o_orderkey", parts=5, **driver)
    assert whole.rdd.getNumPartitions() == 5
    lower = whole.select(*(F.col(c).alias(c.lower()) for c in whole.columns))
    assert lower.exceptAll(rows.where("o_orderkey % 2 = 0")).isEmpty() and lower.count() == rows.where("o_orderkey % 2 = 0").count()
    per = tables.jdbc_query(spark, url, 'SELECT "o_custkey", count(*) AS n FROM orders GROUP BY "o_custkey"', **driver)
    assert per.agg(F.sum("N")).first()[0] == whole.count()
    again = rows.unionByName(rows.where("o_orderkey % 10 = 1"))
    assert tables.jdbc_new_rows(again, url, "orders", ["o_orderkey"], **driver) == rows.where("o_orderkey % 2 = 1").count()
    assert tables.jdbc_new_rows(again, url, "orders", ["o_orderkey"], **driver) == 0
    whole = tables.jdbc_query(spark, url, "SELECT * FROM orders", split="o_orderkey", **driver)
    assert whole.count() == rows.count() == whole.select("o_orderkey").distinct().count()
    assert tables.jdbc_query(spark, url, 'SELECT * FROM orders WHERE "o_orderkey" < 0', split="o_orderkey", **driver).count() == 0
