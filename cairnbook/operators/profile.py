"""Column profiles in long form: one row per column, from a few aggregates over all columns at once."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .selection import distinct_counts, medians

#: What makes a column suspicious.
NULL_RATIO, UNIQUE_RATIO, BALANCE_LOW, BALANCE_HIGH, OUTLIER = 0.5, 0.9, 0.25, 0.75, 3.0
STATS = (
    "null_count distinct_count mean stddev median extreme_count min_value max_value avg_length median_length max_length "
    "empty_count true_count false_count true_frequency earliest_date latest_date"
).split()
_TEXT = {"min_value", "max_value", "earliest_date", "latest_date"}
_COUNTS = {"null_count", "distinct_count", "extreme_count", "empty_count", "true_count", "false_count", "max_length"}


def _type(stat: str) -> str:
    return "string" if stat in _TEXT else "bigint" if stat in _COUNTS else "double"


PROFILE = ", ".join(["column_name string", "data_type string", "total_count bigint", *(f"{s} {_type(s)}" for s in STATS)])


def _measures(c: Column, kind: T.DataType) -> dict[str, Column]:
    """What one aggregate gives for a column; distinct counts, medians and outliers come from further ones."""
    out = {"null_count": F.count_if(c.isNull())}
    if isinstance(kind, T.NumericType):
        out |= {"min_value": F.min(c), "max_value": F.max(c), "mean": F.avg(c), "stddev": F.stddev(c)}
    elif isinstance(kind, T.DateType):
        out |= {"earliest_date": F.min(c), "latest_date": F.max(c)}
    elif isinstance(kind, T.StringType):
        n = F.length(c)
        out |= {"avg_length": F.avg(n), "max_length": F.max(n), "empty_count": F.count_if(F.trim(c) == "")}
    elif isinstance(kind, T.BooleanType):
        out |= {"true_count": F.count_if(c), "false_count": F.count_if(~c), "true_frequency": F.avg(c.cast("int"))}
    return out


def profile(df: DataFrame) -> DataFrame:
    """column_name, data_type, total_count and the statistics of STATS; those that a type does not have are null.

    df is read a few times, by jobs that run at once: distinct values and medians are counted (see ``selection``), outliers
    need mean and deviation first. A costly df should be a stored table. The driver holds one row a column.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if not fields:
        return df.sparkSession.createDataFrame([], PROFILE)
    columns = [F.col(f"`{f.name}`") for f in fields]
    of = lambda kind: [i for i, f in enumerate(fields) if isinstance(f.dataType, kind)]
    measures = [F.struct(*(v.cast(_type(s)).alias(s) for s, v in _measures(c, f.dataType).items())).alias(f"c{i}") for i, (f, c) in enumerate(zip(fields, columns, strict=True))]
    first = df.agg(F.count("*").alias("n"), *measures).first()
    rows = [first[f"c{i}"].asDict() for i in range(len(fields))]
    distinct = distinct_counts(df, [f.name for f in fields])
    middle = medians(df, {str(i): columns[i].cast("double") for i in of(T.NumericType)} | {str(i): F.length(columns[i]).cast("double") for i in of(T.StringType)})
    wide = [i for i in of(T.NumericType) if rows[i]["stddev"]]
    score = lambda i: F.abs((columns[i].cast("double") - rows[i]["mean"]) / rows[i]["stddev"])
    far = df.agg(*(F.count_if(score(i) > OUTLIER).alias(f"x{i}") for i in wide)).first() if wide else {}
    for i, row in enumerate(rows):
        # nulls count as a value of their own
        row["distinct_count"] = distinct[fields[i].name] + (row["null_count"] > 0) if first.n else None
        if isinstance(fields[i].dataType, T.NumericType):
            row |= {"median": middle[str(i)], "extreme_count": far[f"x{i}"] if i in wide else 0}
        elif isinstance(fields[i].dataType, T.StringType):
            row["median_length"] = middle[str(i)]
    found = [(f.name, f.dataType.simpleString(), first.n, *(row.get(s) for s in STATS)) for f, row in zip(fields, rows, strict=True)]
    return df.sparkSession.createDataFrame(found, PROFILE)


def suspicious(profiled: DataFrame) -> DataFrame:
    """column_name, rule, value for each rule that a column breaks."""
    filled = F.col("total_count") - F.col("null_count")
    rules = {
        "high_null_ratio": (F.try_divide("null_count", "total_count"), lambda v: v > NULL_RATIO),
        "extreme_values_count": (F.col("extreme_count").cast("double"), lambda v: v > 0),
        "extreme_imbalance": (F.try_divide("true_count", filled), lambda v: (v >= BALANCE_HIGH) | (v <= BALANCE_LOW)),
        "high_cardinality": (F.when(F.col("data_type") == "string", F.try_divide("distinct_count", filled)), lambda v: v > UNIQUE_RATIO),
    }
    found = F.array(*(F.when(test(v), F.struct(F.lit(name).alias("rule"), v.cast("double").alias("value"))) for name, (v, test) in rules.items()))
    return profiled.select("column_name", F.explode(F.array_compact(found)).alias("r")).select("column_name", "r.*")


def duplicates(df: DataFrame, keys: tuple[str, ...] = ("assetNumber", "reportingPeriodEndDate"), source: str = "source_file") -> DataFrame:
    """Keys of more than one row: their number, the sorted files, and whether these are several.

    The files of a key are a set of distinct names; its rows are counted, not gathered.
    """
    found = df.groupBy(*keys).agg(F.count("*").alias("count"), F.sort_array(F.collect_set(source)).alias("source_files"))
    return found.where("count > 1").withColumn("is_cross_file", F.size("source_files") > 1)


def require_keys(df: DataFrame, keys: tuple[str, ...] = ("assetNumber", "reportingPeriodEndDate")) -> None:
    lacking = F.lit(False)
    for k in keys:
        lacking = lacking | F.col(k).isNull()
    if not df.where(lacking).isEmpty():
        raise ValueError("Found null values in key columns")


class History:
    """Profiles of earlier runs in a JSON file; a missing or broken file starts anew, writes are atomic."""

    def __init__(self, path: str | os.PathLike):
        self.path = Path(path)

    def load(self) -> dict[str, list[dict]]:
        try:
            return json.loads(self.path.read_text() or "{}")
        except (FileNotFoundError, json.JSONDecodeError):
            return {}

    def append(self, profiled: DataFrame) -> None:
        """Adds a run: one small row a column."""
        known = self.load()
        for row in profiled.toLocalIterator():
            stats = {k: v for k, v in row.asDict().items() if v is not None}
            known.setdefault(row.column_name, []).append(stats)
        self.path.parent.mkdir(parents=True, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=self.path.parent, delete=False) as f:
            json.dump(known, f, indent=1, default=str)
        os.replace(f.name, self.path)
