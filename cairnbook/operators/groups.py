"""Ranks and averages over groups of any size: few groups may hold all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number_below

#: Groups up to which what is known of them is sent to all executors.
GROUPS_SENT = 20_000
#: Ranges that a group's values are cut into, and parts that rows of one frequent value are dealt to.
RANGES, PARTS = 64, 64


def _sent(df: DataFrame, groups: int | None) -> DataFrame:
    return F.broadcast(df) if groups is not None and groups <= GROUPS_SENT else df


def number_of_groups(rows: DataFrame, by: Sequence[str]) -> int:
    """Of rows that are cheap to read, such as a stored table's."""
    return rows.select(*by).distinct().count()


def with_group_means(rows: DataFrame, by: Sequence[str], means: Mapping[str, Column], groups: int | None = None, digits: int | None = None) -> DataFrame:
    """rows with the averages of their group, nulls in ``by`` being a group as in a window.

    The averages are made from partial ones and joined back, so no group's rows come together. groups: a proven bound on the
    number of groups; up to GROUPS_SENT the averages are sent and rows stay where they are, else Spark joins by its own
    measure, and splits a frequent group. digits: decimals that averages are rounded to, once a group.
    """
    key = "_group"
    known = rows.withColumn(key, F.struct(*by))
    near = lambda c: c if digits is None else F.round(c, digits)
    found = known.groupBy(key).agg(*(near(F.avg(c)).alias(n) for n, c in means.items()))
    return known.join(_sent(found, groups), key, "left").drop(key)


def with_rank(rows: DataFrame, by: Sequence[str], value: str, rank: str = "rank", percent: str | None = None, descending: bool = False, nulls_first: bool = False, groups: int | None = None, ranges: int = RANGES) -> DataFrame:
    """rows with rank() of a number or date within their group and, if named, percent_rank(); both as a window gives them.

    A group's values are cut into ranges at approximate quantiles. Rows of a range are ranked by themselves, and the ranges
    before, counted, are its offset. A cut is a range of its own, so a value that many rows have is one: its rows all have
    the same rank, need no order, and are dealt to several tasks. groups: as in ``with_group_means``.
    """
    known = rows.withColumn("_group", F.struct(*by))
    v = F.col(value)
    cuts = known.groupBy("_group").agg(F.percentile_approx(v, [i / ranges for i in range(1, ranges)], 100 * ranges).alias("_cuts"))
    cuts = cuts.select("_group", F.array_distinct(F.coalesce("_cuts", F.array().cast(dict(cuts.dtypes)["_cuts"]))).alias("_cuts"))
    below = number_below(F.col("_cuts"), v, ranges)
    cut = F.array_contains("_cuts", v)
    last = 2 * ranges + 1
    place = 2 * below + cut.cast("int")
    null_place = F.lit(-1) if nulls_first else F.lit(last)
    place = F.when(v.isNull(), null_place).otherwise((last - 1) - place if descending else place)
    even = F.coalesce(cut, F.lit(True))
    # the part of a row must be the same whenever a lost task runs again
    part = F.when(even, F.pmod(F.xxhash64(*(F.col(f"`{n}`") for n, k in rows.dtypes if "map" not in k)) + F.spark_partition_id(), F.lit(PARTS))).otherwise(0)
    placed = known.join(_sent(cuts, groups), "_group").withColumns({"_place": place.cast("int"), "_part": part}).drop("_cuts")
    counts = placed.groupBy("_group", "_place").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy("_group").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_group", "_place", (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy("_group")).alias("_all"))
    order = v.desc_nulls_first() if descending and nulls_first else v.desc_nulls_last() if descending else v.asc_nulls_first() if nulls_first else v.asc_nulls_last()
    own = F.rank().over(Window.partitionBy("_group", "_place", "_part").orderBy(order)).cast("long")
    out = placed.withColumn("_own", own).join(_sent(offsets, groups), ["_group", "_place"])
    place_of = F.col("_before") + F.col("_own")
    new = {rank: place_of}
    if percent is not None:
        new[percent] = F.when(F.col("_all") > 1, (place_of - 1) / (F.col("_all") - 1)).otherwise(0.0)
    return out.withColumns(new).select(*(F.col(f"`{c}`") for c in rows.columns), *new)
