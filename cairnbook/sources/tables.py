"""Stored tables: discovery, reading several at once, appending, keyed merges, JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import merged, new_rows, unique
from .scratch import kept


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a write there has been committed."""
    path, fs = _path(spark, f"{folder}/_SUCCESS")
    return fs.exists(path)


def datasets(spark: SparkSession, root: str, name: str) -> list[str]:
    """Finished datasets ``root/company/trust/name``; only the folder names are listed."""
    path, fs = _path(spark, f"{root}/*/*/{name}")
    found = fs.globStatus(path) or []
    return sorted(p for p in (str(x.getPath().toString()) for x in found) if finished(spark, p))


def read_together(spark: SparkSession, paths: Sequence[str], name: str) -> DataFrame:
    """All datasets as one; columns that some lack are null there, company and trust come from the path where missing."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths)
    where = F.col("_metadata.file_path")
    for column, n in (("company", 1), ("trust", 2)):
        part = F.url_decode(F.regexp_extract(where, rf"([^/]+)/([^/]+)/{name}/", n))
        df = df.withColumn(column, F.coalesce(column, part) if column in df.columns else part)
    return df


def append(df: DataFrame, folder: str, partition: Sequence[str] = ()) -> None:
    """Snappy Parquet, optionally by partition columns."""
    df.write.mode("append").option("compression", "snappy").partitionBy(*partition).parquet(folder)


def save_table(df: DataFrame, name: str, path: str, partition: Sequence[str] = (), sort: Sequence[str] = ()) -> None:
    """A catalogue table in place of any before it, with statistics.

    Rows sorted by ``sort`` in each file let readers skip row groups by their minima and maxima, where a server would
    use an index.
    """
    df.sortWithinPartitions(*sort, *([] if sort else partition or df.columns[:1])).write.mode("overwrite").partitionBy(*partition).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def _moved(fs, old, new) -> None:
    """Renames, and fails where the file system says or shows that it did not: many report that by their result alone."""
    if not fs.rename(old, new) or not fs.exists(new):
        raise OSError(f"could not rename {old.toString()} to {new.toString()}")


def _recovered(spark: SparkSession, folder: str) -> bool:
    """Whether there is a table at ``folder``, after putting right what an interrupted replacement has left there.

    A replacement is three renames' worth of states: new table beside the old; old one moved to ``._old``; new one in place.
    """
    (path, fs), (old, _), (new, _) = (_path(spark, folder + x) for x in ("", "._old", "._next"))
    if not fs.exists(path) and fs.exists(old):
        _moved(fs, new if finished(spark, f"{folder}._next") else old, path)
    if fs.exists(path):
        fs.delete(old, True)
    return fs.exists(path)


def replace(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    """Puts df in place of the table at ``folder``, which df may read: it is written beside it first.

    The old table is only moved away once the new one is complete, and deleted once that is seen in place, so at any moment
    one of them is whole; where the second rename fails the old one goes back, and the next upsert finishes or undoes what
    was interrupted. Between the renames there is no table to read: ``versions`` has tables whose readers never wait.
    """
    (path, fs), (old, _), (new, _) = (_path(spark, folder + x) for x in ("", "._old", "._next"))
    df.write.mode("overwrite").parquet(f"{folder}._next")
    if fs.exists(path):
        _moved(fs, path, old)
    try:
        _moved(fs, new, path)
    except OSError:
        if fs.exists(old) and not fs.exists(path):
            _moved(fs, old, path)
        raise
    fs.delete(old, True)
    spark.catalog.refreshByPath(folder)
    return spark.read.parquet(folder)


def upsert(spark: SparkSession, changes: DataFrame, folder: str, keys: Sequence[str], evolve: bool = False) -> DataFrame:
    """Inserts or replaces rows by key; a failed or interrupted write leaves the old table (see ``replace``)."""
    if not _recovered(spark, folder):
        return replace(spark, unique(changes, keys), folder)
    return replace(spark, merged(spark.read.parquet(folder), changes, keys, evolve), folder)


#: Touched partitions up to which their names are sent to all executors.
PARTITIONS_SENT = 100_000


def upsert_partitions(spark: SparkSession, changes: DataFrame, folder: str, keys: Sequence[str], partition: str) -> None:
    """The same for a table in partitions: only those that the changes touch are read and rewritten.

    Keys are told apart within a partition. The rewritten partitions are staged first; each then takes its old one's place
    by itself, and running the same changes again gives the same table.
    """
    if not finished(spark, folder):
        unique(changes, keys).write.mode("overwrite").partitionBy(partition).parquet(folder)
        return
    touched = changes.select(partition).distinct()
    old = spark.read.parquet(folder)
    if touched.count() <= PARTITIONS_SENT:
        touched = F.broadcast(touched)
    hit = old.join(touched, partition, "left_semi").select(old.columns)
    staged = f"{folder}._staged"
    merged(hit, changes.select(old.columns), keys).write.mode("overwrite").parquet(staged)
    writer = spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(folder)
    path, fs = _path(spark, staged)
    fs.delete(path, True)
    spark.catalog.refreshByPath(folder)


def _quoted(spark: SparkSession, url: str, name: str) -> str:
    """A column's name as that server's SQL has it."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)


def jdbc_query(spark: SparkSession, url: str, sql: str, split: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A query's result over JDBC. ``split``, a number, date or time of it, reads it in ``parts`` ranges at once, between the
    ends that the server names first; without rows, or with one value, it is one read."""
    read = spark.read.format("jdbc").option("url", url).options(**options)
    if split is not None:
        name = _quoted(spark, url, split)
        ends = read.option("dbtable", f"(SELECT min({name}) AS a, max({name}) AS b FROM ({sql}) q) e").load().first()
        low, high = ends[0], ends[1]
        if low is not None and low != high:
            read = read.option("partitionColumn", split).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts)
    return read.option("dbtable", f"({sql}) q").load()


def jdbc_append(df: DataFrame, url: str, table: str, at_once: int = 8, **options: str) -> None:
    """Appends rows, over ``at_once`` connections at the most; each part is one transaction of the server."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("numPartitions", at_once).options(**options).mode("append").save()


def jdbc_new_rows(df: DataFrame, url: str, table: str, keys: Sequence[str], **options: str) -> int:
    """Appends the rows whose keys the server's table does not have, each key once; how many. Only the keys are read.

    The rows are stored before the first is sent: reading them again while the table grows would skip what is not there yet.
    """
    known = jdbc_query(df.sparkSession, url, f"SELECT {', '.join(_quoted(df.sparkSession, url, k) for k in keys)} FROM {table}", **options)
    known = known.select(*(F.col(c).alias(k) for c, k in zip(known.columns, keys, strict=True)))
    fresh = kept(new_rows(df.dropDuplicates(list(keys)), known, keys), "jdbc")
    jdbc_append(fresh, url, table, **options)
    return fresh.count()


def records(spark: SparkSession, sql: str) -> Iterator[dict]:
    """A query's rows as dicts, one partition at a time."""
    return (r.asDict() for r in spark.sql(sql).toLocalIterator())


def columns_of(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of each column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
