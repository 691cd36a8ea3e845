"""A corpus pipeline of five of the operators: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage takes the documents that the one before it kept, and its result is written and read again as the next one's
input, so a lost executor costs one task of one stage. All but the last return the columns of ``documents``.

Rejected documents go; of each near-duplicate group the document with the smallest id stays, rows with a null id or one
that several rows have being judged by their texts and standing behind all others; documents that a benchmark item leaked
into go, with or without an id; personal data is masked, and ``n_chars`` follows the text; the
rest is packed into training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnbook.llm import decontamination, minhash_dedup, packing, pii, quality_rules
from cairnbook.llm.shared import Scratch, free_name, prepare, sent_if_small, table
from cairnbook.operators.rows import numbered


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    own = free_name(docs, "quality")
    return quality_rules.verdict(docs, into=own).where(F.col(own)["kept"]).drop(own)


#: Similarity, in percent, from which the near-duplicates stage links two documents.
NEAR_PERCENT = 80


def _with_node(docs: DataFrame, own: str) -> DataFrame:
    """docs with a column ``own``: a number of its own for each id, or, where an id is null or several rows have it, for each
    id and text. Ids that one row has come first, as they are; the others are numbered behind them, by id and text."""
    spark, id_ = docs.sparkSession, F.col("doc_id")
    again = docs.where(id_.isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = Scratch(spark, "ids").keep(again, "again")
    odd = docs.where(id_.isNull()).unionByName(docs.join(sent_if_small(again), "doc_id", "left_semi").select(docs.columns))
    if odd.isEmpty():
        return docs.withColumn(own, id_)
    single = docs.where(id_.isNotNull()).join(sent_if_small(again), "doc_id", "left_anti").select(docs.columns).withColumn(own, id_)
    said = [F.xxhash64(F.lit(i), F.coalesce("text", F.lit(""))) for i in (0, 1)]
    keys = [free_name(docs, f"key{i}") for i in range(3)]
    odd = odd.withColumns({keys[0]: F.coalesce(id_, F.lit(0)), keys[1]: said[0], keys[2]: said[1]}).withColumn(keys[0], F.struct(id_.isNull(), keys[0]))
    numbers = numbered(odd.select(keys).distinct(), [F.col(k) for k in keys], own)
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    odd = odd.join(numbers, keys).withColumn(own, F.col(own) + F.lit(max(0, top) + 1))
    # of rows with one id and one text, the smallest by the other columns stays
    odd = odd.groupBy(own).agg(F.min(F.struct(*docs.columns)).alias(keys[0])).select(f"{keys[0]}.*", own)
    return single.unionByName(odd)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, scratch = free_name(docs, "node"), Scratch(spark, "gone")
    nodes = _with_node(docs, own)
    found = minhash_dedup.near_duplicates(spark, nodes.select(own, "text"), id_col=own, percent=NEAR_PERCENT)
    gone = scratch.keep(found.where("not kept").select(found.columns[0]).distinct().toDF(own), "ids")
    return nodes.join(sent_if_small(gone), own, "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decides by id and text, so rows without an id, or with that of another row, are judged by what they say."""
    own = free_name(docs, "row")
    key = F.struct(F.xxhash64(F.lit(0), "doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id"))
    docs_ = docs.withColumn(own, key)
    found = decontamination.leaks(spark, docs_.select(own, "text"), table(spark, sf_dir, "benchmark"), id_col=own)
    found = Scratch(spark, "leaks").keep(found.select(F.col("doc_id").alias(own)).distinct(), "ids")
    return docs_.join(sent_if_small(found), own, "left_anti").select(docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = free_name(docs, "pii")
    spans = F.col(own)["all"]
    text = pii.masked(F.coalesce("text", F.lit("")), spans)
    found = pii.detected(docs, into=own)
    found = found.withColumn("text", F.when(F.size(spans) > 0, text).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.packed(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", private),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs


#: Near-duplicates and packing are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None
