"""What the operators share: table reading, intermediate tables in the cluster's shared folder, Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset and all runs in one process (tests, a laptop), one
    temporary folder a session. On a cluster it must be set: executors do not share a machine's folders."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = getattr(context, "_cairnbook_folder", None)
        if folder is None:
            folder = "file://" + tempfile.mkdtemp(prefix="cairnbook-")
            context._cairnbook_folder = folder
    return folder.rstrip("/")


class Scratch:
    """Intermediate tables, written to the shared folder and read back: a lost executor never loses them, and lineage ends there.

    ``keep`` writes a table, ``drop`` deletes one that no later step reads; what is left goes when the program ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._end)

    def _end(self) -> None:
        if SparkContext._active_spark_context is self.spark.sparkContext:
            with contextlib.suppress(Exception):  # the session may be going down
                self.drop("")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def keep(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, hadoop = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(hadoop).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of df has it."""
    while name in df.columns:
        name = f"_{name}"
    return name


#: Rows of a few numbers each up to which a side is sent to all executors.
SMALL_ROWS = 4_000_000


def sent_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to have few rows; a larger side is left to a shuffle join.

    For tables of keys and numbers, so that a join with whole texts doesn't move the texts.
    """
    return F.broadcast(df) if df.count() <= rows else df


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Once a session: send this package to the executors, and bound Arrow batches to ``rows`` rows, so that a batch of
    long texts stays within an executor's memory."""
    context = spark.sparkContext
    if not getattr(context, "_cairnbook_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp()) / "cairnbook.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, f"{package.name}/{file.relative_to(package)}")
        context.addPyFile(str(archive))
        context._cairnbook_sent = True
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
