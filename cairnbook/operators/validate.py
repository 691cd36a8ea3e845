"""Validation, casting and imputation of text columns against a declared schema.

Rules become one array of messages per row; the distinct messages are aggregated on the executors, so the driver sees a
message once, however many rows break the rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parsed_date
from ..sources.schema import ColumnSpec

#: Literals and limits of the declared types.
TRUE, FALSE = ("true", "1", "yes", "t", "y"), ("false", "0", "no", "f", "n")
UNSIGNED = {"UInt8": 255, "UInt16": 65535}
FLOATS = {"Float32": 3.4028235e38, "Float64": 1.7976931348623157e308}
CONTROL = r"[\x00-\x1F\x7F]"
DATES = r"^(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])-\d{4}|\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01]))$"


def rules(name: str, spec: ColumnSpec, scope: Column | None = None) -> list[tuple[Column, str]]:
    """(condition, message) of each rule of a column; ``scope`` limits the rules on missing values to some rows."""
    c, kind, out = F.col(name), spec.type, []
    within = (lambda x: x) if scope is None else (lambda x: scope & x)
    if kind in ("string", "char"):
        if spec.size:
            out.append((F.length(c) > spec.size, f"string length exceeds {spec.size} in {name}"))
        if not spec.allow_control_chars:
            out.append((c.rlike(CONTROL), f"invalid control characters in {name}"))
        if not spec.nullable:
            out.append((within(F.trim(c) == ""), f"empty string values in {name}"))
    elif kind == "number":
        digits = rf"^-?\d{{1,{spec.whole}}}" + (rf"(?:\.\d{{1,{spec.decimal}}})?$" if spec.decimal else "$")
        out.append((c.isNotNull() & ~c.cast("string").rlike(digits), f"numeric value exceeds {spec.whole}.{spec.decimal} format in {name}"))
    elif kind == "date":
        out.append((c.isNotNull() & ~c.cast("string").rlike(DATES), f"invalid date values in {name}"))
    elif kind in UNSIGNED:
        v = c.try_cast("double")
        bad = v.isNull() | (v < 0) | (v > UNSIGNED[kind]) | (v != F.floor(v))
        out.append((c.isNotNull() & bad, f"outside {kind} range in {name}"))
    elif kind in FLOATS:
        v = c.try_cast("double")
        out.append((c.isNotNull() & (v.isNull() | (F.abs(v) > FLOATS[kind])), f"invalid floating-point values in {name}"))
    if not spec.nullable:
        out.append((within(c.isNull()), f"null values in non-nullable field {name}"))
    return out


def messages(df: DataFrame, specs: Mapping[str, ColumnSpec], scopes: Mapping[str, Column] | None = None) -> DataFrame:
    """The distinct messages (column ``message``) over all rows."""
    found = [F.when(bad, F.lit(text)) for name, spec in specs.items() if name in df.columns for bad, text in rules(name, spec, (scopes or {}).get(name))]
    if not found:
        return df.select(F.lit("").alias("message")).limit(0)
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("message")).distinct()


def cast_clean(df: DataFrame, specs: Mapping[str, ColumnSpec]) -> DataFrame:
    """Columns in their declared types; declared columns that are missing come as typed nulls."""
    out = {}
    for name, spec in specs.items():
        c = F.col(name)
        if name not in df.columns:
            out[name] = F.lit(None).cast(spec.spark_type())
        elif spec.type == "bool":
            low = F.lower(c.cast("string"))
            out[name] = F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False)
        elif spec.type == "date":
            out[name] = parsed_date(c.cast("string"))
        elif spec.type in ("string", "char"):
            out[name] = F.trim(F.regexp_replace(c, CONTROL, ""))
        else:
            out[name] = c.try_cast(spec.spark_type())
    return df.withColumns(out)


def imputed(df: DataFrame, specs: Mapping[str, ColumnSpec]) -> DataFrame:
    """Declared constants in place of nulls."""
    return df.withColumns({
        name: F.coalesce(name, F.lit(spec.imputation).cast(spec.spark_type()))
        for name, spec in specs.items()
        if name in df.columns and spec.nullable and spec.imputation is not None
    })


def validated(df: DataFrame, specs: Mapping[str, ColumnSpec]) -> DataFrame:
    """df cast and cleaned; ValueError with all messages, sorted, if any rule is broken."""
    extra = sorted(c for c in df.columns if c not in specs)
    if extra:
        raise ValueError(f"Found columns in DataFrame that are not defined in schema: {', '.join(extra)}")
    found = [f"Non-nullable field {n} is missing in DataFrame" for n, s in specs.items() if not s.nullable and n not in df.columns]
    found += [r.message for r in messages(df, specs).collect()]  # at most one a rule
    if found:
        raise ValueError(f"Multiple validation errors found: {', '.join(sorted(found))}")
    return cast_clean(df, specs)


def validated_together(tables: Mapping[str, DataFrame], specs: Mapping[str, Mapping[str, ColumnSpec]]) -> dict[str, DataFrame]:
    """Several tables in one pass: columns that they share must be declared alike; rules on missing values are scoped
    to the tables that declare them."""
    joint: dict[str, ColumnSpec] = {}
    owners: dict[str, list[str]] = {}
    for table, own in specs.items():
        for name, spec in own.items():
            if name in joint and joint[name] != spec:
                raise ValueError(f"column {name} is declared differently for {table} and {owners[name][0]}")
            joint[name] = spec
            owners.setdefault(name, []).append(table)
    both = None
    for table, df in tables.items():
        if extra := sorted(c for c in df.columns if c not in specs[table]):
            raise ValueError(f"Found columns in DataFrame that are not defined in schema: {', '.join(extra)}")
        tagged = df.withColumn("_table", F.lit(table))
        both = tagged if both is None else both.unionByName(tagged, allowMissingColumns=True)
    scopes = {n: F.col("_table").isin(*o) for n, o in owners.items() if len(o) < len(tables)}
    lacking = [f"Non-nullable field {n} is missing in DataFrame" for t, df in tables.items() for n, s in specs[t].items() if not s.nullable and n not in df.columns]
    found = sorted({*lacking, *(r.message for r in messages(both, joint, scopes).collect())})
    if found:
        raise ValueError(f"Multiple validation errors found: {', '.join(found)}")
    clean = cast_clean(both, joint)
    return {t: clean.where(F.col("_table") == t).select(*specs[t]) for t in tables}


def single_property(df: DataFrame, key: str = "assetNumber", child: str = "property") -> DataFrame:
    """Assets with more than one property."""
    return df.where(F.col(child).isNotNull()).groupBy(key).count().where("count > 1")


def boolean_literals(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is none of true, false, 1, 0, NULL."""
    return df.where(~F.lower(F.col(column)).isin("true", "false", "1", "0", "null"))


def required_nulls(df: DataFrame, columns: tuple[str, ...] = ("assetNumber", "reportingPeriodEndDate", "company")) -> DataFrame:
    """Null count of each required column."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return one.unpivot([], list(columns), "column_name", "null_count")
