"""Expressions that the models share."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: What stands for a null part in a surrogate key; the open end of a validity interval.
NULL_PART = "_dbt_utils_surrogate_key_null_"
FOREVER = "9999-12-31"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts as text, joined by a dash; nulls have a marker of their own."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("-", *(F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in columns)))


def filled(value: str, running: WindowSpec, whole: WindowSpec, order: Sequence[str]) -> Column:
    """The latest non-null value up to the row (rows of equal first order included), else the first one there is.

    Several values on one date: the last by the rest of ``order`` counts, so the result never depends on row order.
    """
    tagged = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v")))
    return F.coalesce(F.max(tagged).over(running)["_v"], F.min(tagged).over(whole)["_v"])


def home(asset: str) -> Column:
    """What an asset's rows are dealt by: its number up to the first '_', without the 'A's of split notes. A loan, its split
    notes, its properties and whatever has a key of theirs (number_property) have one home."""
    return F.rtrim(F.substring_index(asset, "_", 1), F.lit("A"))


def months_between_parts(later: Column, earlier: Column) -> Column:
    """Whole months from ``earlier`` to ``later``: complete years and months of the symbolic difference, with its sign."""
    def whole(a: Column, b: Column) -> Column:
        months = (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
        return months - F.when(F.dayofmonth(a) < F.dayofmonth(b), 1).otherwise(0)

    return F.when(later >= earlier, whole(later, earlier)).otherwise(-whole(earlier, later)).cast("long")


def month_part(later: Column, earlier: Column) -> Column:
    """The months component (0 to 11, with sign) of the difference."""
    return months_between_parts(later, earlier) % 12


def double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom as doubles; null where bottom is zero."""
    return double(top) / F.nullif(double(bottom), F.lit(0.0))


def mean(c: Column | str) -> Column:
    """Average from the exact sum: the same on every engine and in any order."""
    column = F.col(c) if isinstance(c, str) else c
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def ladder(steps: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    out = None
    for condition, value in steps:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def below(c: Column, bounds: Sequence[tuple[object, str]], rest: str, inclusive: bool = False) -> Column:
    """A bucket by ascending upper bounds."""
    return ladder([((c <= b) if inclusive else (c < b), name) for b, name in bounds], rest)


def parsed_date(c: Column) -> Column:
    """Dates in month-day-year or year-month-day."""
    return F.coalesce(F.try_to_date(c, "MM-dd-yyyy"), F.try_to_date(c, "yyyy-MM-dd"))


#: Abbreviations of words after the first in physical column names.
ABBREVIATIONS = {
    "percentage": "pct",
    "amount": "amt",
    "number": "num",
    "balance": "bal",
    "interest": "intr",
    "principal": "prin",
    "payment": "pmt",
    "beginning": "begin",
    "ending": "end",
    "original": "orig",
    "expiration": "exp",
}
LONGEST_NAME = 63
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z][a-z])|(?<=[A-Z][a-z])(?=[A-Z])")


def snake_case(name: str) -> str:
    """A camelCase name in lower-case words with underscores, abbreviated, at most 63 characters."""
    first, *rest = [w for w in re.split(r"[^a-z0-9]+", _CAMEL.sub("_", name).lower()) if w] or [""]

    def short(word: str) -> str:
        long = next((x for x in ABBREVIATIONS if word.startswith(x)), None)
        return ABBREVIATIONS[long] + word[len(long) :] if long else word

    return "_".join([first, *map(short, rest)])[:LONGEST_NAME]


def number_below(cuts: Column, v: Column, most: int) -> Column:
    """How many of the ascending values of the array ``cuts``, ``most`` at the most, are less than v: a binary search by halves."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(most.bit_length()))))
    more = lambda at, p: at + F.when(F.coalesce(F.get(cuts, at + p - 1) < v, F.lit(False)), p).otherwise(0)
    return F.aggregate(steps, F.lit(0), more)
