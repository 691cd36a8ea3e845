"""Stages of the pipeline on rows without an id, and on ids that several rows have."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairnbook.llm.shared import prepare


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string"


def said(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "own") for i, t, s in rows], SCHEMA).repartition(3)


def test_near_duplicates_by_id_and_text(spark, folder):
    rows = [
        (1, said(1), "x"), (2, said(1), "x"),  # plain copies: 1 stays
        (3, said(3), "x"), (3, said(4), "y"),  # one id, nothing in common: both stay
        (5, said(5), "x"), (5, said(5), "w"), (5, said(5), "x"),  # repeated rows: one stays
        (None, said(6), "x"), (None, said(6), "v"), (None, said(7), "x"),  # of rows without an id one of each text
        (None, said(1), "x"), (3, said(1), "x"),  # copies of 1
        (8, None, "x"), (9, "", "x"), (None, None, "x"), (10, "short", "x"),
    ]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, rows), folder)
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    got = sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=repr)
    want = [(1, said(1), "x"), (3, said(3), "x"), (3, said(4), "y"), (5, said(5), "w"), (None, said(6), "v"), (None, said(7), "x"), (8, None, "x"), (9, "", "x"), (None, None, "x"), (10, "short", "x")]
    assert got == sorted(want, key=repr)


def test_unique_ids_are_left_as_they_are(spark, folder):
    rows = [(i, said(i // 2), "x") for i in range(40)]
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), folder).collect()}
    assert got == set(range(0, 40, 2))
    assert corpus_pipeline.near_duplicates(spark, documents(spark, []), folder).collect() == []


def test_leaks_without_an_id_go(spark, folder):
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").where(F.length("text") > 100).orderBy("item_id").limit(2).collect()]
    clean = [(1, said(1), "x"), (None, said(2), "x"), (4, said(3), "x"), (7, None, "x")]
    leaked = [(2, f"{said(4)} {items[0]} {said(5)}", "x"), (None, f"{said(4)} {items[0]} {said(5)}", "x"), (None, f"{items[1]} {said(6)}", "x"), (4, f"{said(7)} {items[1]}", "x")]
    out = corpus_pipeline.decontaminated(spark, documents(spark, clean + leaked), folder)
    assert sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=repr) == sorted(clean, key=repr)
