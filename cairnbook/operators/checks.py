"""Declarative checks: each returns the rows that violate it, so an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys without nulls that occur more than once, with their count."""
    full = F.lit(True)
    for c in columns:
        full = full & F.col(c).isNotNull()
    return df.where(full).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.where(bad)


def between(df: DataFrame, column: str, low: Column | object, high: Column | object) -> DataFrame:
    """Values outside low..high; the bounds may be expressions, such as the current date."""
    return df.where(~F.col(column).between(low, high))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def exclusive_ranges(df: DataFrame, lower: str, upper: str, key: str) -> DataFrame:
    """Rows whose range reaches beyond the start of the next one of the same key."""
    w = Window.partitionBy(key).orderBy(lower, upper)
    return df.withColumn("next_lower", F.lead(lower).over(w)).where(F.col("next_lower") < F.col(upper))
