"""The operators' queries, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    fill_middle,
    hard_negatives,
    html_extract,
    language_id,
    minhash_dedup,
    packing,
    pii,
    preference_format,
    quality_rules,
    repeat_spans,
    url_filter,
    warc,
)
from .shared import prepare, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op1(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op2(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_rules.op3(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op4(spark, table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op5(spark, table(spark, sf_dir, "pages"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.op6(spark, table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.op7(spark, table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.op8(table(spark, sf_dir, "documents"))


def op9_repeat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_spans.op9(spark, table(spark, sf_dir, "documents"))


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_format.op10(table(spark, sf_dir, "conversations"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fill_middle.op11(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.op12(spark, table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.op13(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_pii,
        op3_quality_rules,
        op4_url_filter,
        op5_warc,
        op6_minhash_dedup,
        op7_html_extract,
        op8_packing,
        op9_repeat_spans,
        op10_preference_format,
        op11_fill_middle,
        op12_language_id,
        op13_hard_negatives,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op4_url_filter": url_filter.OP4_SQL,
    "op10_preference_format": preference_format.OP10_SQL,
    "op11_fill_middle": fill_middle.OP11_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
