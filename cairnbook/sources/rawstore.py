"""A store of raw files by key that fetches and writes nothing twice.

Contents are rows (sha256, content) of Parquet, one folder a run; which key has which content, in which run, is a versioned
table. A key that is there is skipped, whatever its content now is, and equal contents are stored once. What a run has
written counts only from the table's next version on: a run that dies leaves no key behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import VersionedTable

#: Keys up to which they are sent to the contents; more meet them in a shuffle.
KEYS_SENT = 200_000
_MANIFEST = "key string, sha256 string, n_bytes long, run string"


class RawStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.table = VersionedTable(spark, f"{self.folder}/manifest")

    def manifest(self) -> DataFrame:
        """key, sha256, n_bytes, run of all that is stored."""
        return self.table.read() if self.table.versions() else self.spark.createDataFrame([], _MANIFEST)

    def missing(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose key is not stored, each key once: what is still to be fetched."""
        return keys.where("key is not null").dropDuplicates(["key"]).join(self.manifest().select("key"), "key", "left_anti")

    def save(self, files: DataFrame) -> int:
        """Stores files (key, content as binary) whose keys are not there; how many these were. Files without content are
        not stored; of several contents with one key the least hash stands."""
        run = uuid.uuid4().hex
        files = files.where("key is not null and content is not null").select("key", "content", F.sha2("content", 256).alias("sha256"))
        path = f"{self.folder}/incoming/{run}"
        # keys and hashes only: contents stay where they are until one row has been chosen for each
        narrow = files.select("key", "sha256", F.octet_length("content").cast("long").alias("n_bytes"))
        one = narrow.groupBy("key").agg(F.min(F.struct("sha256", "n_bytes")).alias("x"), F.count("*").alias("n"))
        one.select("key", "x.*", "n").join(self.manifest().select("key"), "key", "left_anti").write.parquet(path)
        keys = self.spark.read.parquet(path)
        n = keys.count()
        if n:
            known = self.manifest().groupBy("sha256").agg(F.min("run").alias("_run"))
            fresh = keys.join(known.select("sha256"), "sha256", "left_anti").groupBy("sha256").agg(F.min_by(F.struct("key", "n"), "key").alias("x"))
            fresh = fresh.select("sha256", "x.*")
            single, several = fresh.where("n = 1").select("key", "sha256"), fresh.where("n > 1").select("key", "sha256")
            sent = F.broadcast if n <= KEYS_SENT else lambda x: x
            # only a key of several rows can give a content twice
            contents = files.join(sent(single), ["key", "sha256"], "left_semi").select("sha256", "content")
            twice = files.join(sent(several), ["key", "sha256"], "left_semi").select("sha256", "content").dropDuplicates(["sha256"])
            contents.unionByName(twice).write.parquet(f"{self.folder}/content/{run}")
            rows = keys.join(known, "sha256", "left").select("key", "sha256", "n_bytes", F.coalesce("_run", F.lit(run)).alias("run"))
            if self.table.versions():
                self.table.upsert(rows)
            else:
                self.table.create(rows, ["key"])
        p, fs = self.table._path(f"../incoming/{run}")
        fs.delete(p, True)
        return n

    def read(self) -> DataFrame:
        """key, sha256, n_bytes, content of all that is stored."""
        runs = [r.run for r in self.manifest().select("run").distinct().collect()]
        if not runs:
            return self.spark.createDataFrame([], "key string, sha256 string, n_bytes long, content binary")
        paths = [f"{self.folder}/content/{r}" for r in runs]
        stored = self.spark.read.schema("sha256 string, content binary").parquet(*paths)
        stored = stored.withColumn("run", F.regexp_extract("_metadata.file_path", r"/content/([0-9a-f]{32})/", 1))
        return self.manifest().join(stored, ["sha256", "run"]).select("key", "sha256", "n_bytes", "content")
