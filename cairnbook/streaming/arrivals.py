"""Filings as a stream: the same keyed merge as the batch, for each micro-batch of new files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.rows import first_per_key
from ..sources import tables


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def merge_stream(stream: DataFrame, target: str, keys: Sequence[str], order: str, checkpoint: str, once: bool = True, buckets: int = 64) -> StreamingQuery:
    """Merges each micro-batch into the table at ``target``: per key, the row with the greatest ``order`` stands.

    The table lies in ``buckets`` partitions by a hash of the keys (column ``_bucket``, which ``merged_table`` leaves out); a
    micro-batch rewrites only those it has keys of. One that is run again after a failure merges the same rows: the result
    is the same.
    """
    spark, own = stream.sparkSession, [*keys, "_bucket"]

    def put(batch: DataFrame, _: int) -> None:
        latest = first_per_key(batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), keys, [F.desc(order)])
        if tables.finished(spark, target):
            old = spark.read.parquet(target).join(latest.select(*own), own, "left_semi").select(latest.columns)
            latest = first_per_key(old.unionByName(latest), keys, [F.desc(order)])
        tables.upsert_partitions(spark, latest, target, own, "_bucket")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def merged_table(spark: SparkSession, target: str) -> DataFrame:
    """What ``merge_stream`` has merged so far."""
    return spark.read.parquet(target).drop("_bucket")


def monthly_totals(stream: DataFrame, date: str, amount: str, late: str = "40 days") -> DataFrame:
    """Running totals by event-time windows of 30 days; rows later than the watermark are dropped, as in any stream."""
    when = F.col(date).cast("timestamp")
    rows = stream.withColumn("_t", when).withWatermark("_t", late)
    return rows.groupBy(F.window("_t", "30 days")).agg(F.sum(amount).alias("total"), F.count("*").alias("n"))
