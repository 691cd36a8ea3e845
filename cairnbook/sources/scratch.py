"""Folders for tables that a query writes on its way, shared by driver and executors."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and all runs in one process, one temporary folder a session."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not hasattr(context, "_cairnbook_tables"):
        context._cairnbook_tables = "file://" + tempfile.mkdtemp(prefix="cairnbook-tables-")
    return context._cairnbook_tables


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name, deleted when the program ends."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"

    def end() -> None:
        if SparkContext._active_spark_context is spark.sparkContext:
            with contextlib.suppress(Exception):  # the session may be going down
                delete(spark, path)

    atexit.register(end)
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: later steps don't compute it again, and a lost executor doesn't lose it."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
