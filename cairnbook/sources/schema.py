"""Declared schemas: column specs, a versioned registry of JSON files, DDL."""

from __future__ import annotations

import json
import os
import re
import tempfile
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import types as T

from ..functions.columns import snake_case

_PLAIN = {
    "string": T.StringType(), "char": T.StringType(), "Int8": T.ByteType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType(),
    "UInt8": T.ShortType(), "UInt16": T.IntegerType(), "UInt32": T.LongType(), "Float32": T.FloatType(), "Float64": T.DoubleType(),
    "date": T.DateType(), "datetime": T.TimestampType(), "bool": T.BooleanType(), "binary": T.BinaryType(),
}
_SQL = {"date": "DATE", "bool": "BOOLEAN", "UInt8": "SMALLINT", "UInt16": "INTEGER", "UInt32": "BIGINT", "Int16": "SMALLINT"}


@dataclass(frozen=True)
class ColumnSpec:
    """A declared column."""

    type: str
    nullable: bool = True
    size: int | None = None
    whole: int = 0
    decimal: int = 0
    imputation: object = None
    allow_control_chars: bool = False
    description: str = ""

    def spark_type(self) -> T.DataType:
        if self.type == "number":
            return T.DecimalType(self.whole + self.decimal, self.decimal)
        if self.type not in _PLAIN:
            raise ValueError(f"unknown type {self.type}")
        return _PLAIN[self.type]

    def sql_type(self) -> str:
        if self.type == "string":
            return f"VARCHAR({self.size})" if self.size else "TEXT"
        if self.type == "char":
            return f"CHAR({self.size or 1})"
        if self.type == "number":
            return f"NUMERIC({self.whole + self.decimal},{self.decimal})"
        if self.type not in _SQL:
            raise ValueError(f"type {self.type} has no SQL type")
        return _SQL[self.type]


Specs = dict[str, ColumnSpec]


def specs_from(data: Mapping[str, Mapping]) -> Specs:
    known = set(ColumnSpec.__dataclass_fields__)
    return {name: ColumnSpec(**{k: v for k, v in spec.items() if k in known}) for name, spec in data.items()}


def struct_type(specs: Specs) -> T.StructType:
    """Fields with size, imputation and description as metadata."""
    return T.StructType([
        T.StructField(n, s.spark_type(), s.nullable, {k: v for k, v in asdict(s).items() if v not in (None, "") and k not in ("type", "nullable")})
        for n, s in specs.items()
    ])


def text_type(specs: Specs) -> T.StructType:
    """All columns as text: what a scan reads before validation."""
    return T.StructType([T.StructField(n, T.StringType()) for n in specs])


def common_fields(*tables: Specs) -> dict[str, T.DataType]:
    """Types of the columns that all tables declare."""
    first, *rest = tables
    return {n: s.spark_type() for n, s in first.items() if all(n in r for r in rest)}


def ddl(table: str, specs: Specs) -> str:
    """CREATE TABLE with physical names; the columns that may not be null are the primary key."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    lines = [f"  {snake_case(n)} {s.sql_type()}{'' if s.nullable else ' NOT NULL'}" for n, s in specs.items()]
    keys = [snake_case(n) for n, s in specs.items() if not s.nullable]
    if keys:
        lines.append(f"  PRIMARY KEY ({', '.join(keys)})")
    notes = [f"COMMENT ON COLUMN {table}.{snake_case(n)} IS {quote(s.description)};" for n, s in specs.items() if s.description]
    return "\n".join([f"CREATE TABLE IF NOT EXISTS {table} (", ",\n".join(lines), ");", *notes])


class Registry:
    """Schemas by table name, each version a JSON file ``<name>_v<N>.json``; versions are ordered as numbers."""

    def __init__(self, folder: str | os.PathLike):
        self.folder = Path(folder)

    def versions(self, name: str) -> list[int]:
        found = (re.fullmatch(rf"{re.escape(name)}_v(\d+)\.json", p.name) for p in self.folder.glob(f"{name}_v*.json"))
        return sorted(int(m[1]) for m in found if m)

    def load(self, name: str, version: int | None = None) -> Specs:
        known = self.versions(name)
        if not known:
            return specs_from(json.loads((self.folder / f"{name}.json").read_text()))
        return specs_from(json.loads((self.folder / f"{name}_v{version or known[-1]}.json").read_text())["columns"])

    def save(self, name: str, specs: Specs, note: str = "") -> int:
        """Writes the next version, atomically."""
        self.folder.mkdir(parents=True, exist_ok=True)
        version = max([0, *self.versions(name)]) + 1
        body = {"version": version, "saved": datetime.now(timezone.utc).isoformat(), "note": note, "columns": {n: asdict(s) for n, s in specs.items()}}
        with tempfile.NamedTemporaryFile("w", dir=self.folder, delete=False) as f:
            json.dump(body, f, indent=1)
        os.replace(f.name, self.folder / f"{name}_v{version}.json")
        return version

    def history(self, name: str) -> list[dict]:
        out = []
        for v in self.versions(name):
            body = json.loads((self.folder / f"{name}_v{v}.json").read_text())
            out.append({k: body[k] for k in ("version", "saved", "note")} | {"columns": len(body["columns"])})
        return out
