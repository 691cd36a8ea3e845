"""A keyed table kept as versions, so that an upsert is one atomic step for all readers.

Rows lie in buckets by a hash of their keys. A version is a manifest, a small JSON file that names the folder of each
bucket, the schema and the keys; the latest version is the one with the greatest number. An upsert writes new folders for
the buckets that its changes touch and takes the others from the version before, then puts its manifest in place by one
rename that fails if that number exists. Nothing that a version names is ever changed, so a reader stays on the version it
began with, and a job that dies at any point leaves the table as it was, plus files that no manifest names; ``vacuum``
deletes those. Of two writers at once one commits and the other merges again into what that left.

The rename must be atomic and must not overwrite, as in HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rows import merged, unique

BUCKETS = 64
ATTEMPTS = 20
_OWN = "_bucket"


class Manifest(NamedTuple):
    version: int
    keys: list[str]
    buckets: int
    schema: dict
    #: Folder of each bucket that has rows, under the table's.
    parts: dict[str, str]


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- files

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write_data(self, rows: DataFrame, name: str) -> None:
        rows.write.partitionBy(_OWN).parquet(f"{self.folder}/data/{name}")

    def _write_text(self, name: str, text: str) -> None:
        path, fs = self._path(name)
        out = fs.create(path, False)
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()

    def _rename(self, old: str, new: str) -> bool:
        """False if there is a file of that name already; nothing is overwritten."""
        gateway = self.spark.sparkContext._gateway
        hadoop = gateway.jvm.org.apache.hadoop.fs
        (a, _), (b, _) = self._path(old), self._path(new)
        files = hadoop.FileContext.getFileContext(a.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(a, b, gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def _names(self, folder: str, pattern: str = "*") -> list[str]:
        path, fs = self._path(f"{folder}/{pattern}")
        return sorted(x.getPath().getName() for x in fs.globStatus(path) or [])

    # --- versions

    def versions(self) -> list[int]:
        return [int(x.removesuffix(".json")) for x in self._names("versions", "*.json")]

    def manifest(self, version: int | None = None) -> Manifest:
        """Of a version, or the latest; version 0 is no table yet."""
        version = max(self.versions(), default=0) if version is None else version
        if version == 0:
            return Manifest(0, [], 0, {}, {})
        text = "\n".join(r.value for r in self.spark.read.text(f"{self.folder}/versions/{version:020d}.json", wholetext=True).collect())
        return Manifest(**json.loads(text))

    def _committed(self, new: Manifest) -> bool:
        name = f"versions/_{uuid.uuid4().hex}"
        self._write_text(name, json.dumps(new._asdict()))
        return self._rename(name, f"versions/{new.version:020d}.json")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, or of the latest: a DataFrame that later upserts don't change."""
        m = self.manifest(version)
        if m.version == 0:
            raise ValueError(f"there is no table at {self.folder}")
        schema = T.StructType.fromJson(m.schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{p}" for p in m.parts.values())) if m.parts else self.spark.createDataFrame([], schema)

    def create(self, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
        """The first version. Fails if there is one, or if two rows have one key."""
        if not keys:
            raise ValueError("the table has no key")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        return self._put(Manifest(0, list(keys), buckets, schema.jsonValue(), {}), unique(rows, keys))

    def upsert(self, changes: DataFrame, evolve: bool = False) -> DataFrame:
        """Inserts rows, or puts them in place of those with their keys; only buckets with changes are rewritten.

        Rows with a null key are inserted. Two changes with one key fail the job. evolve: columns that only one side has are
        kept, null on the other. Columns of both take the table's types.
        """
        for _ in range(ATTEMPTS):
            m = self.manifest()
            if m.version == 0:
                raise ValueError(f"there is no table at {self.folder}")
            schema = T.StructType.fromJson(m.schema)
            types = {f.name: f.dataType for f in schema}
            rows = changes.select(*(F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in changes.columns))
            bucket = self._bucket(m)
            touched = sorted(str(r[0]) for r in rows.select(bucket).distinct().collect())  # at most as many as buckets
            old = [f"{self.folder}/{m.parts[b]}" for b in touched if b in m.parts]
            before = self.spark.read.schema(schema).parquet(*old) if old else self.spark.createDataFrame([], schema)
            after = merged(before, rows, m.keys, evolve)
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in after.schema])
            try:
                return self._put(m._replace(schema=schema.jsonValue()), after)
            except FileExistsError:  # another writer's version came first
                continue
        raise RuntimeError(f"other writers came first {ATTEMPTS} times")

    @staticmethod
    def _bucket(m: Manifest) -> Column:
        return F.pmod(F.xxhash64(*(f"`{k}`" for k in m.keys)), F.lit(m.buckets)).cast("int").alias(_OWN)

    def _put(self, base: Manifest, rows: DataFrame) -> DataFrame:
        """A version after ``base``, with ``rows`` as the new content of their buckets."""
        name = uuid.uuid4().hex
        self._write_data(rows.withColumn(_OWN, self._bucket(base)).repartition(_OWN), name)
        new = {x.split("=")[1]: f"data/{name}/{x}" for x in self._names(f"data/{name}", f"{_OWN}=*")}
        if not self._committed(base._replace(version=base.version + 1, parts=base.parts | new)):
            raise FileExistsError(f"version {base.version + 1} of {self.folder} exists")
        return self.read(base.version + 1)

    def vacuum(self, keep: int = 2, hours: float = 24) -> int:
        """Deletes all versions but the last ``keep``, and data older than ``hours`` that no version names; how many folders
        and files went. Readers of deleted versions fail; writes that take longer than that would be lost."""
        gone = self.versions()[:-keep]
        named = {p.split("/")[1] + "/" + p.split("/")[2] for v in self.versions()[-keep:] for p in self.manifest(v).parts.values()}
        for v in gone:
            path, fs = self._path(f"versions/{v:020d}.json")
            fs.delete(path, False)
        now, count = self.spark._jvm.System.currentTimeMillis(), len(gone)
        for write in self._names("data"):
            mine = self._names(f"data/{write}")
            left = [x for x in mine if f"{write}/{x}" not in named and x.startswith(_OWN)]
            whole = len(left) == len([x for x in mine if x.startswith(_OWN)])
            for name in [f"data/{write}"] if whole else [f"data/{write}/{x}" for x in left]:
                path, fs = self._path(name)
                if now - fs.getFileStatus(path).getModificationTime() >= hours * 3_600_000:
                    fs.delete(path, True)
                    count += 1
        for name in self._names("versions", "_*"):
            path, fs = self._path(f"versions/{name}")
            if now - fs.getFileStatus(path).getModificationTime() >= hours * 3_600_000:
                fs.delete(path, False)
                count += 1
        return count
