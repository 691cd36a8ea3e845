"""Choosing, changing and merging rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which should be total. Catalyst limits the window's groups before the
    shuffle, so a key with many rows costs one row a task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def new_rows(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose keys are not stored yet; rows with a null key are new."""
    return incoming.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def missing_columns(wanted: Iterable[str], df: DataFrame) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def unknown_columns(df: DataFrame, known: Iterable[str]) -> list[str]:
    known = set(known)
    return [c for c in df.columns if c not in known]


def merge_checks(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> None:
    """What must hold before a merge: there are keys, and the columns are exactly the target's."""
    if not keys:
        raise ValueError("the target has no primary key")
    if extra := unknown_columns(df, columns):
        raise ValueError(f"columns that the target does not have: {', '.join(sorted(extra))}")
    if lacking := missing_columns(columns, df):
        raise ValueError(f"columns that are missing: {', '.join(sorted(lacking))}")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df as it is; a job that reads it fails where two rows have the same keys, none of them null."""
    known = " and ".join(f"`{k}` is not null" for k in keys)
    n = F.when(F.expr(known), F.count("*").over(Window.partitionBy(*keys))).otherwise(1)
    fails = F.assert_true(F.col("_n") == 1, F.lit(f"several changes with one key ({', '.join(keys)})"))
    return df.withColumn("_n", n).where(fails.isNull()).drop("_n")


def merged(target: DataFrame, changes: DataFrame, keys: Sequence[str], evolve: bool = False) -> DataFrame:
    """``target`` with ``changes`` inserted or put in place of the rows with their keys.

    evolve: columns that only one side has are kept, null on the other. Of several changes with one key none would be the
    one that stands: they fail the job, as a server's upsert would.
    """
    if not evolve:
        merge_checks(changes, target.columns, keys)
    changes = unique(changes, keys)
    kept = target.join(changes.select(*keys).distinct(), list(keys), "left_anti").select(target.columns)
    return kept.unionByName(changes, allowMissingColumns=evolve)


def since_latest(df: DataFrame, target: DataFrame, column: str, inclusive: bool = False) -> DataFrame:
    """Rows after (or from) the latest ``column`` of ``target``: all rows of an empty target."""
    top = target.agg(F.max(column).alias("_top"))
    later = F.col(column) >= F.col("_top") if inclusive else F.col(column) > F.col("_top")
    return df.join(F.broadcast(top)).where(F.col("_top").isNull() | later).drop("_top")


def as_of_versions(facts: DataFrame, versions: DataFrame, key: str, at: str, how: str = "inner", start: str = "effective_date", end: str = "end_date", home: str | None = None) -> DataFrame:
    """Each fact with the version of its key that was valid at its date: start <= date < end. home: as in ``joined_at_home``."""
    v = versions.withColumnRenamed(key, "_key")
    fits = (facts[at] >= v[start]) & (facts[at] < v[end])
    if home:
        v = v.withColumnRenamed(home, "_home")
        return joined_at_home(facts, v, facts[home] == v["_home"], facts[key] == v["_key"], fits, how).drop("_key", "_home")
    return facts.join(v, (facts[key] == v["_key"]) & fits, how).drop("_key")


def joined_at_home(left: DataFrame, right: DataFrame, home: Column, same: Column, fits: Column, how: str = "inner") -> DataFrame:
    """Rows whose homes are equal, and of which ``same`` and ``fits`` hold, where ``same`` implies equal homes.

    Both sides are dealt by home already. As a condition within a home, not as keys of the join, the rest deals nothing anew.
    So homes should be small: each row of one is compared with those of the other side.
    """
    return left.join(right, home & F.when(same, fits).otherwise(False), how)


def numbered(df: DataFrame, order: Sequence[Column], into: str = "number") -> DataFrame:
    """df with the numbers 0, 1, ... of its rows by ``order``, which should be total: it must tell all rows apart that differ.

    Rows are dealt by range and written with their place in their part; the parts' sizes, one number each, give where each
    begins. So no task has all rows, as a window without groups would.
    """
    own = "_place"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(own, F.monotonically_increasing_id())
    dealt = kept(dealt, "numbered")
    part = F.shiftright(own, 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a part
    starts = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start")))
    out = dealt.withColumn("_part", part).join(starts, "_part")
    return out.withColumn(into, F.col("_start") + F.col(own).bitwiseAND((1 << 33) - 1)).select(*df.columns, into)


def aligned(table: DataFrame, chosen: DataFrame, by: str = "number") -> DataFrame:
    """The rows of ``table`` with the numbers of ``chosen``, beside its columns, numbered anew from 0 in the same order.

    For two tables that were numbered together, of which one has been filtered since.
    """
    both = chosen.join(table, by)
    return numbered(both.withColumnRenamed(by, "_old"), [F.col("_old")], by).drop("_old")
