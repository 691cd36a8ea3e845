"""Tables laid out along a space-filling curve, so that a range of any of several keys lies in a share of the files.

Each key becomes its place among approximate quantiles, the bits of the places are interleaved (Z-order), and files are
ranges of the result. The least and greatest keys of each file are kept beside the data: a reader opens only files that can
have rows of its ranges. This is what a server would use indexes for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import number_below

#: Bits of a key's place: so many quantiles, as a power of two.
BITS = 8


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """One number of which the places' bits take turns, the first place's highest bit first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, place in enumerate(places):
            at = bit * len(places) + len(places) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(place.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), at))
    return out


def curve(df: DataFrame, keys: Sequence[str], into: str, bits: int = BITS) -> DataFrame:
    """df with each row's place on the curve; nulls come first in their key. Keys are numbers, dates or times."""
    if len(keys) * bits > 62:
        raise ValueError(f"{len(keys)} keys of {bits} bits are more than 62")
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*(F.array_distinct(F.percentile_approx(F.col(k), shares, 10_000)).alias(f"_cuts{i}") for i, k in enumerate(keys)))
    places = {f"_place{i}": number_below(F.col(f"_cuts{i}"), F.col(k), 2**bits - 1) for i, k in enumerate(keys)}
    return df.join(F.broadcast(cuts)).withColumns(places).withColumn(into, interleaved([F.col(n) for n in places], bits)).select(*df.columns, into)


def write_clustered(df: DataFrame, folder: str, keys: Sequence[str], files: int) -> None:
    """df as about ``files`` files along the curve, and a table of their ranges. A place that many rows have is several files."""
    own = "_curve"
    dealt = curve(df, keys, own)
    spread = F.xxhash64(*(F.col(f"`{n}`") for n, k in df.dtypes if "map" not in k))
    dealt.repartitionByRange(files, F.col(own), spread).sortWithinPartitions(own).drop(own).write.parquet(f"{folder}/data")
    ends = [f(F.col(k)).alias(f"{name}_{k}") for k in keys for name, f in (("least", F.min), ("greatest", F.max))]
    nulls = [F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys]
    stored = df.sparkSession.read.parquet(f"{folder}/data")
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n_rows"), *ends, *nulls).coalesce(1).write.parquet(f"{folder}/ranges")


def files_of(spark: SparkSession, folder: str, ranges: Mapping[str, tuple[Any, Any]]) -> tuple[list[str], int]:
    """Names of the files that can have rows with each key in its range, both ends included; and how many files there are."""
    known = spark.read.parquet(f"{folder}/ranges")
    fits = F.lit(True)
    for k, (low, high) in ranges.items():
        fits = fits & (F.col(f"greatest_{k}") >= F.lit(low)) & (F.col(f"least_{k}") <= F.lit(high))
    return [r.file for r in known.where(fits).select("file").collect()], known.count()


def read_ranges(spark: SparkSession, folder: str, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The rows with each key in its range; only files that can have such rows are opened."""
    files, _ = files_of(spark, folder, ranges)
    whole = spark.read.parquet(f"{folder}/data") if not files else spark.read.parquet(*files)
    for k, (low, high) in ranges.items():
        whole = whole.where(F.col(k).between(F.lit(low), F.lit(high)))
    return whole
