"""The registered queries and the pipeline, over whole test tables."""

import re

import pytest
from oracle import assert_equal, connect
from pyspark.sql import functions as F
from test_small_operators import brute_components, brute_pii, brute_quality

import corpus_pipeline
from cairnbook.llm import decontamination, queries
from cairnbook.llm.shared import Scratch


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, folder, name):
    assert_equal(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLE_SQL[name])


def test_whole_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
    for n in ("op2_pii", "op3_quality_rules", "op6_minhash_dedup", "op9_repeat_spans"):
        assert sorted(r.doc_id for r in queries.QUERIES[n](spark, folder).select("doc_id").collect()) == ids
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    components, _ = brute_components(texts)
    got = {r.doc_id: r.component_id for r in queries.QUERIES["op6_minhash_dedup"](spark, folder).collect()}
    assert got == components


def test_pipeline_against_brute_force(spark, folder):
    """Each stage is held against plain Python on its own input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_quality", F.lit("own")).withColumn("pii", F.lit("own"))
    scratch, kept = Scratch(spark, "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = before = docs
        docs = scratch.keep(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == before.columns
    text = {n: {r.doc_id: r.text for r in d.collect()} for n, d in kept.items()}
    for i, t in text["quality_rules"].items():
        n, _, _, _, repeated = brute_quality(t)
        if n < 20 or 100 * repeated > 30 * n:
            assert i not in text["near_duplicates"]
    components, _ = brute_components(text["near_duplicates"].items(), 80)
    assert set(text["decontamination"]) == {i for i, c in components.items() if i == c}
    leaks = decontamination.leaks(spark, kept["decontamination"], spark.read.parquet(f"{folder}/benchmark.parquet"))
    found = {r.doc_id for r in leaks.collect()}
    assert set(text["personal_data"]) == set(text["decontamination"]) - found
    # plain Python: a document that holds an item word for word goes, and what goes has much of one
    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda t: {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
    items = [plain(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for i, t in text["decontamination"].items():
        said = f" {' '.join(plain(t))} "
        if any(len(x) > 8 and f" {' '.join(x)} " in said for x in items):
            assert i in found
        if i in found:
            assert max(len(grams(x) & grams(plain(t))) / max(1, len(grams(x))) for x in items) >= 0.4
    for i, t in text["packing"].items():
        assert brute_pii(t) == [] and (brute_pii(text["personal_data"][i]) != [] or len(t) <= len(text["personal_data"][i]))
    assert {r.doc_id for r in docs.collect()} == set(text["packing"])


def test_pipeline_runs(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
