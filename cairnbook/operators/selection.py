"""Exact medians and distinct counts of many columns at once, by counting.

Values go through in long form (column number, value), so that one shuffle of narrow, pre-aggregated rows serves all
columns; no task holds a column's values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that the values of a column are counted in each round.
RANGES = 2048


def distinct_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of different values of each column, nulls left out.

    A value is two 64-bit hashes with different seeds. Equal values meet in the tasks first, then by (column, hashes), and
    only the counts of the second level are few; a column of one value costs a row a task, one of a key a narrow row each.
    """
    if not columns:
        return {}
    values = (F.struct(F.lit(i).alias("c"), F.when(F.col(f"`{n}`").isNotNull(), F.xxhash64(F.lit(0), f"`{n}`")).alias("h"), F.xxhash64(F.lit(1), f"`{n}`").alias("g")) for i, n in enumerate(columns))
    long = df.select(F.explode(F.array(*values)).alias("x")).select("x.*").where("h is not null")
    found = {r.c: r.n for r in long.groupBy("c", "h", "g").agg(F.lit(1)).groupBy("c").agg(F.count("*").alias("n")).collect()}
    return {n: found.get(i, 0) for i, n in enumerate(columns)}


class _Search(NamedTuple):
    """Where the two middle rows of a column are: in [low, high], behind ``before`` smaller rows."""

    first: int
    last: int
    low: float
    high: float
    before: int


def _finite(v: Column) -> Column:
    return F.when(F.abs(v) < math.inf, v)


def medians(df: DataFrame, values: Mapping[str, Column], at: float = 0.5) -> dict[str, float | None]:
    """The exact quantile ``at`` of each column (values as doubles): between two middle rows the mean, weighted by place;
    null without values. NaN counts as the greatest value.

    Each round counts rows by ranges of the values that are left, with each range's least and greatest value, and goes on in
    the range with the middle. Ranges are of equal width, in every second round of the logarithm, so that neither even nor
    very uneven values take many rounds.
    """
    names = list(values)
    if not names:
        return {}
    columns = [values[n].cast("double") for n in names]
    ends = df.agg(*(f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("n", F.count), ("a", lambda c: F.min(_finite(c))), ("b", lambda c: F.max(_finite(c)))))).first()
    found: dict[int, dict[int, float]] = {}
    left: dict[int, _Search] = {}
    for i in range(len(names)):
        if n := ends[f"n{i}"]:
            place = (n - 1) * at
            # no finite value: all are in the ranges outside
            left[i], found[i] = _Search(math.floor(place), math.ceil(place), ends[f"a{i}"] or 0.0, ends[f"b{i}"] or 0.0, 0), {}
    rounds, whole = 0, True
    while left:
        rows = _counted(df, columns, left, whole, rounds % 2 == 1)
        for i, search in list(left.items()):
            row, again = search.before, None
            for low, high, n in rows.get(i, []):
                for k in (search.first, search.last):
                    if k == row or (row < k < row + n and (low == high or math.isnan(low))):
                        found[i][k] = low
                    elif k == row + n - 1:
                        found[i][k] = high
                    elif row < k < row + n:
                        again = search._replace(low=low, high=high, before=row)
                row += n
            if again is None:
                del left[i]
            else:
                left[i] = again
        rounds, whole = rounds + 1, False
    return {n: _between(found[i], (ends[f"n{i}"] - 1) * at) if i in found else None for i, n in enumerate(names)}


def _between(found: dict[int, float], place: float) -> float:
    a, b = found[math.floor(place)], found[math.ceil(place)]
    return a if a == b else a + (b - a) * (place - math.floor(place))


def _counted(df: DataFrame, columns: list[Column], left: dict[int, _Search], whole: bool, log: bool) -> dict[int, list[tuple[float, float, int]]]:
    """Least value, greatest value and rows of each range of each column that is searched, in order.

    whole: the first round, when values that are not finite count too, each in a range of its own.
    """
    scale = (lambda v: F.signum(v) * F.log1p(F.abs(v))) if log else (lambda v: v)
    parts = []
    for i, s in left.items():
        v = columns[i]
        # quarters: the difference of two doubles may be no double
        low, high = (scale(F.lit(x)) / 4 for x in (s.low, s.high))
        share = F.coalesce(F.try_divide(scale(v) / 4 - low, high - low), F.lit(0.0))
        bucket = F.least(F.lit(RANGES - 2), F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * (RANGES - 1)).cast("int"))
        # the greatest value has a range of its own, so that every round leaves fewer values
        bucket = F.when(v >= s.high, RANGES - 1).otherwise(bucket)
        if whole:
            bucket = F.when(F.isnan(v), RANGES + 1).when(v == math.inf, RANGES).when(v == -math.inf, -1).otherwise(bucket)
            inside = v.isNotNull()
        else:
            inside = v.between(s.low, s.high)
        parts.append(F.when(inside, F.struct(F.lit(i).alias("c"), bucket.alias("r"), v.alias("v"))))
    long = df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.*")
    counted = long.groupBy("c", "r").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    out: dict[int, list[tuple[float, float, int]]] = {}
    for r in sorted(counted.collect(), key=lambda r: (r.c, r.r)):  # at most RANGES rows a column
        out.setdefault(r.c, []).append((r.low, r.high, r.n))
    return out
