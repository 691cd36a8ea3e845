"""Versioned tables: upserts that die at any step, readers on their version, writers at once."""

import pytest
from pyspark.sql import functions as F

from cairnbook.sources.versions import VersionedTable

TABLE = "k long, v string, m int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.create(spark.createDataFrame([(i, f"v{i}", i % 3) for i in range(40)], TABLE), ["k"], buckets=8)
    return t


def change(spark, *changed):
    return spark.createDataFrame(list(changed), TABLE)


def test_upsert_and_pinned_readers(spark, table):
    before = table.read()
    after = table.upsert(change(spark, (1, "new", 9), (100, "more", None), (None, "nobody", 1)))
    assert rows(before) == sorted(((i, f"v{i}", i % 3) for i in range(40)), key=repr)
    want = {i: (i, f"v{i}", i % 3) for i in range(40)} | {1: (1, "new", 9), 100: (100, "more", None), None: (None, "nobody", 1)}
    assert rows(after) == rows(table.read()) == sorted(want.values(), key=repr)
    # again: a null key is new each time, the others stand
    assert table.upsert(change(spark, (1, "new", 9), (None, "nobody", 1))).count() == 43
    assert table.versions() == [1, 2, 3] and rows(table.read(1)) == rows(before)


def test_only_touched_buckets_are_rewritten(spark, table):
    first, _ = table.manifest(), table.upsert(change(spark, (7, "x", 0)))
    second = table.manifest()
    assert sum(first.parts[b] != second.parts[b] for b in first.parts) == 1


def test_types_and_columns(spark, table):
    out = table.upsert(spark.createDataFrame([(3, "x", 1.0, True)], "k int, v string, m double, extra boolean"), evolve=True)
    assert out.dtypes == [("k", "bigint"), ("v", "string"), ("m", "int"), ("extra", "boolean")] and out.where("k = 3").first().extra
    assert out.count() == 40 and out.where("extra is null").count() == 39
    with pytest.raises(ValueError, match="missing"):
        table.upsert(spark.createDataFrame([(3,)], "k long"))
    with pytest.raises(Exception, match="several changes with one key"):
        table.upsert(spark.createDataFrame([(3, "a", 1, True), (3, "b", 1, True)], "k long, v string, m int, extra boolean"))
    assert table.versions() == [1, 2]


class Dies(Exception):
    pass


STEPS = ["before data", "half the data", "after data", "before manifest", "half a manifest", "before rename", "after rename"]


@pytest.mark.parametrize("step", STEPS)
def test_an_upsert_that_dies_leaves_one_table(spark, table, monkeypatch, step):
    """Whatever the step, readers see the version before or, after the rename, the one that was written; the next upsert
    works, and what the dead one left is deleted."""
    data, text, rename = table._write_data, table._write_text, table._rename

    def write_data(df, name):
        if step == "before data":
            raise Dies
        data(df.where("_bucket % 2 = 0") if step == "half the data" else df, name)
        if step in ("half the data", "after data"):
            raise Dies

    def write_text(name, said):
        if step == "before manifest":
            raise Dies
        text(name, said[: len(said) // 2] if step == "half a manifest" else said)
        if step == "half a manifest":
            raise Dies

    def renamed(old, new):
        if step == "before rename":
            raise Dies
        done = rename(old, new)
        if step == "after rename":
            raise Dies
        return done

    for name, f in (("_write_data", write_data), ("_write_text", write_text), ("_rename", renamed)):
        monkeypatch.setattr(table, name, f)
    old, changes = rows(table.read()), change(spark, *((i, "changed", 0) for i in range(0, 60, 2)))
    new = sorted([x for x in old if x[0] % 2] + [(i, "changed", 0) for i in range(0, 60, 2)], key=repr)
    with pytest.raises(Dies):
        table.upsert(changes)
    monkeypatch.undo()
    assert rows(VersionedTable(spark, table.folder).read()) == (new if step == "after rename" else old)
    assert rows(table.upsert(changes)) == new
    table.vacuum(keep=1, hours=0)
    named = {p.split("/")[1] for p in table.manifest().parts.values()}
    assert set(table._names("data")) == named and len(table._names("versions")) == 1
    assert rows(table.read()) == new


def test_two_writers(spark, table, monkeypatch):
    """The second to commit merges again into the version of the first: no change is lost."""
    rename, other = table._rename, VersionedTable(spark, table.folder)

    def late(old, new):
        if table.versions() == [1]:
            other.upsert(change(spark, (1, "first", 0), (2, "first", 0)))
        return rename(old, new)

    monkeypatch.setattr(table, "_rename", late)
    out = {r.k: r.v for r in table.upsert(change(spark, (2, "second", 0), (3, "second", 0))).collect()}
    assert (out[1], out[2], out[3]) == ("first", "second", "second") and table.versions() == [1, 2, 3]
    with pytest.raises(FileExistsError):
        table.create(change(spark, (1, "a", 1)), ["k"])


def test_vacuum_keeps_what_versions_name(spark, table):
    for i in range(3):
        table.upsert(change(spark, (i, "x", 0)))
    kept = rows(table.read(3)), rows(table.read(4))
    assert table.vacuum(keep=2, hours=1) == 2  # the data is younger than that
    table.vacuum(keep=2, hours=0)
    assert table.versions() == [3, 4] and (rows(table.read(3)), rows(table.read(4))) == kept


def test_empty_table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/e")
    with pytest.raises(ValueError, match="no table"):
        t.read()
    with pytest.raises(ValueError, match="no table"):
        t.upsert(change(spark, (1, "a", 1)))
    assert t.create(change(spark), ["k", "m"]).count() == 0
    assert rows(t.upsert(change(spark, (1, "a", 1), (1, "b", 2)))) == [(1, "a", 1), (1, "b", 2)]
    assert t.read().groupBy("k").agg(F.count("*").alias("n")).first().n == 2
