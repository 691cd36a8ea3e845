"""Filings: XML scan, loan and property rows, and the batch that validates and stores them."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import profile, validate
from ..operators.rows import first_per_key, new_rows
from .schema import Specs, text_type

KEYS = {"loans": ["assetNumber", "reportingPeriodEndDate"], "properties": ["assetNumber", "propertyNumber", "reportingPeriodEndDate"]}
_SUFFIX = r"[-.](\d{1,3})$"
ROOT, ROW = "assetData", "assets"
EMPTY_AUDIT = {"new_loans": 0, "new_properties": 0, "duplicate_keys": 0, "suspicious": {}}


def split_asset_number(c: Column) -> tuple[Column, Column]:
    """The number without its suffix, and the suffix in three digits ('000' without one)."""
    return F.regexp_replace(c, _SUFFIX, ""), F.lpad(F.regexp_extract(c, _SUFFIX, 1), 3, "0")


def row_type(loan: Specs, prop: Specs) -> T.StructType:
    """What a filing's rows hold before anything is derived: text columns, and a struct of the property's own."""
    derived = {"company", "trust", "source_file", "propertyNumber", "is_reporting_date_imputed"}
    shared = {"assetTypeNumber", "assetNumber", "assetAddedIndicator", "reportingPeriodEndDate"}
    own = {n: s for n, s in prop.items() if n not in derived | shared}
    top = {n: s for n, s in {**loan, **{n: prop[n] for n in shared if n in prop}}.items() if n not in derived}
    return T.StructType([*text_type(top).fields, T.StructField("property", text_type(own))])


def scan(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of all filings under ``folder/company/trust/102/*.xml``, with where they come from.

    The schema is given, so no pass infers it, and files without a column read it as null.
    """
    rows = spark.read.format("xml").option("rowTag", ROW).option("rootTag", ROOT).schema(schema).load(f"{folder}/*/*/102/*.xml")
    path = F.col("_metadata.file_path")
    base, part = split_asset_number(F.col("assetNumber"))
    # file paths are URIs: a space in a folder's name comes as %20
    where = lambda n: F.url_decode(F.regexp_extract(path, r"([^/]+)/([^/]+)/102/[^/]+$", n))
    return rows.select("*", path.alias("source_file"), where(1).alias("company"), where(2).alias("trust")).withColumns({"propertyNumber": part, "assetNumber": base})


def loan_rows(rows: DataFrame) -> DataFrame:
    return rows.where("propertyNumber = '000'").drop("property", "propertyNumber")


def property_rows(rows: DataFrame, prop: Specs) -> DataFrame:
    """Property children with the keys of their row; a missing date is that of the other rows of its file."""
    dates = rows.groupBy("source_file").agg(F.max("reportingPeriodEndDate").alias("_date"))
    out = rows.where(F.col("property").isNotNull()).join(dates, "source_file", "left")
    own = [c for c in rows.schema["property"].dataType.names if c not in ("assetNumber", "propertyNumber")]
    out = out.select("assetTypeNumber", "assetNumber", "propertyNumber", "assetAddedIndicator", "reportingPeriodEndDate", "_date", "company", "trust", "source_file", *(F.col(f"property.{c}").alias(c) for c in own))
    out = out.withColumn("is_reporting_date_imputed", F.when(F.col("reportingPeriodEndDate").isNull(), "true").otherwise("false"))
    out = out.withColumn("reportingPeriodEndDate", F.coalesce("reportingPeriodEndDate", "_date")).drop("_date")
    return out.select(*(c for c in prop if c in out.columns))


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A stored table, or None before its first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_SUCCESS")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/{name}") if there else None


def ingest(spark: SparkSession, folder: str, out: str, loan: Specs, prop: Specs, history: str | None = None) -> dict:
    """One batch: scan, split, validate, cast, impute, drop what is stored already, deduplicate, append, audit.

    The scan's result is written once and read for all that follows. Returns the audit record.
    """
    raw = f"{out}/_batch"
    scan(spark, folder, row_type(loan, prop)).write.mode("overwrite").parquet(raw)
    rows = spark.read.parquet(raw)
    clean = validate.validated_together({"loans": loan_rows(rows).select(*(c for c in loan if c in rows.columns)), "properties": property_rows(rows, prop)}, {"loans": loan, "properties": prop})
    audit: dict = dict(EMPTY_AUDIT, suspicious={})
    for name, specs in (("loans", loan), ("properties", prop)):
        df = validate.imputed(clean[name], specs)
        profile.require_keys(df)
        if name == "loans":
            audit["duplicate_keys"] = profile.duplicates(df).count()
            profiled = profile.profile(df)
            if history:
                profile.History(history).append(profiled)
            for r in profile.suspicious(profiled).collect():  # a few rows for each column
                audit["suspicious"].setdefault(r.column_name, {})[r.rule] = r.value
        known = stored(spark, out, name)
        before = 0 if known is None else known.count()
        if known is not None:
            df = new_rows(df, known, KEYS[name])
        first_per_key(df, KEYS[name], [F.desc("source_file")]).write.mode("append").parquet(f"{out}/{name}")
        audit[f"new_{name}"] = spark.read.parquet(f"{out}/{name}").count() - before
    return audit


def write_json(path: str | os.PathLike, data: Mapping) -> None:
    """Writes and renames, so that readers see the old file or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=path.parent, delete=False) as f:
        json.dump(data, f, indent=1, default=str)
    os.replace(f.name, path)


def summary(audits: DataFrame) -> DataFrame:
    """Totals over audit rows (new_loans, new_properties, duplicate_keys)."""
    return audits.agg(*(F.sum(c).alias(c) for c in ("new_loans", "new_properties", "duplicate_keys")), F.count("*").alias("batches"))
