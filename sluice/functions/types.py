"""Logical column types: names, the merge lattice and the widening rules.

A type is a Spark ``DataType``; JSON text and other kinds that Spark stores as
strings are told apart by the logical names, which field metadata keeps under
``logical``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

LOGICAL = "logical"
#: White space of all scripts, for the inside of a pattern's brackets; fixed values.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Names that users write for types; fixed values.
TYPE_NAMES = {
    "boolean": "boolean", "bool": "boolean",
    "int8": "int8", "tinyint": "int8", "int16": "int16", "smallint": "int16", "int32": "int32",
    "int": "int64", "integer": "int64", "int64": "int64", "bigint": "int64", "long": "int64",
    "float32": "float32", "float": "float32", "real": "float32", "float4": "float32",
    "float64": "float64", "double": "float64", "float8": "float64",
    "decimal": "decimal", "numeric": "decimal",
    "string": "string", "text": "string", "varchar": "string",
    "binary": "binary", "bytes": "binary", "blob": "binary",
    "date": "date", "time": "time",
    "timestamp": "timestamp", "timestamptz": "timestamp", "datetime": "timestamp",
    "timestamp_ntz": "timestamp_ntz", "timestampntz": "timestamp_ntz",
    "json": "json", "jsonb": "json", "uuid": "uuid", "interval": "interval",
}
_SPARK = {
    "boolean": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(),
    "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType(), "decimal": T.DecimalType(38, 9),
    "string": T.StringType(), "json": T.StringType(), "uuid": T.StringType(), "interval": T.StringType(),
    "unknown": T.StringType(), "binary": T.BinaryType(), "date": T.DateType(), "time": T.TimeType(6),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}
INTEGERS = ("int8", "int16", "int32", "int64")
FLOATS = ("float32", "float64")
TEMPORAL = ("date", "time", "timestamp_ntz", "timestamp")


@dataclass(frozen=True)
class Column:
    """One column of a table schema."""

    name: str
    kind: str
    nullable: bool = True
    precision: int = 0
    scale: int = 0
    max_length: int = 0
    element: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.kind == "decimal":
            return T.DecimalType(self.precision or 38, self.scale)
        if self.kind == "array":
            return T.ArrayType(_SPARK[self.element or "string"])
        return _SPARK[self.kind]

    def field(self) -> T.StructField:
        metadata: dict = {LOGICAL: self.kind}
        if self.max_length:
            metadata["max_length"] = self.max_length
        return T.StructField(self.name, self.spark_type, self.nullable, metadata)


@dataclass
class TableSpec:
    """What a schema alone does not say: keys and the columns that drive loads."""

    name: str
    primary_keys: list[str] = field(default_factory=list)
    incremental_key: str | None = None
    partition_by: str | None = None
    strategy: str | None = None


def kind_of(spark_type: T.DataType) -> str:
    """Logical name of a Spark type; structs, maps and nested lists are JSON text."""
    if isinstance(spark_type, T.DecimalType):
        return "decimal"
    if isinstance(spark_type, T.ArrayType):
        inner = kind_of(spark_type.elementType)
        return "json" if inner in ("json", "array") else "array"
    if isinstance(spark_type, T.TimeType):
        return "time"
    if isinstance(spark_type, (T.StructType, T.MapType, T.NullType, T.VariantType)):
        return "json"
    if isinstance(spark_type, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    names = {type(t): k for k, t in reversed(_SPARK.items()) if not isinstance(t, (T.StringType, T.DecimalType, T.TimeType))}
    return names.get(type(spark_type), "string")


def column_of(f: T.StructField) -> Column:
    """A schema field as a column, with what its metadata says."""
    kind = f.metadata.get(LOGICAL, kind_of(f.dataType))
    precision = scale = 0
    element = None
    if isinstance(f.dataType, T.DecimalType):
        kind, precision, scale = "decimal", f.dataType.precision, f.dataType.scale
    if kind == "array":
        element = kind_of(f.dataType.elementType)
    return Column(f.name, kind, f.nullable, precision, scale, f.metadata.get("max_length", 0), element)


def columns_of(schema: T.StructType) -> list[Column]:
    return [column_of(f) for f in schema.fields]


def parse_type(text: str) -> dict:
    """Attributes of a written type such as ``decimal(10,2)``, ``varchar(50)`` or ``bigint``."""
    m = re.fullmatch(r"\s*([a-zA-Z0-9_]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", text)
    if not m or m[1].lower() not in TYPE_NAMES:
        raise ValueError(f"unknown column type: {text!r}")
    kind = TYPE_NAMES[m[1].lower()]
    out: dict = {"kind": kind}
    if kind == "decimal":
        precision = int(m[2]) if m[2] else 38
        scale = int(m[3]) if m[3] else 0 if m[2] else 9
        if not 0 < precision <= 38 or scale > precision:
            raise ValueError(f"bad decimal: {text!r}")
        out |= {"precision": precision, "scale": scale}
    elif kind == "string" and m[2]:
        out["max_length"] = int(m[2])
    elif m[2]:
        raise ValueError(f"type takes no size: {text!r}")
    return out


def merge_kinds(a: str, b: str) -> str:
    """Common kind of values of two kinds: the inference lattice, associative and commutative on kinds.

    Unknown yields to anything, JSON absorbs all, then text; integers of one
    width stay, of two widths go one step beyond the wider; unlike kinds are text.
    """
    if a == b:
        return a
    pair = {a, b}
    if "json" in pair:
        return "json"
    if "unknown" in pair:
        return (pair - {"unknown"}).pop()
    if "array" in pair:
        return "json"
    if "string" in pair:
        return "string"
    if pair <= {*INTEGERS, *FLOATS, "decimal"}:
        if pair & set(FLOATS):
            return "float64" if "float64" in pair else "float32"
        if "decimal" in pair:
            return "decimal"
        return INTEGERS[min(max(map(INTEGERS.index, pair)) + 1, 3)]
    if pair <= set(TEMPORAL):
        if "timestamp" in pair:
            return "timestamp"
        return "timestamp_ntz"
    return "string"


#: What each kind may be widened to, besides text and JSON, which nearly all may; fixed values.
_WIDER = {
    "int8": ("int16", "int32", "int64", "float64", "decimal"),
    "int16": ("int32", "int64", "float64", "decimal"),
    "int32": ("int64", "float64", "decimal"),
    "int64": ("float64", "decimal"),
    "float32": ("float64",),
    "float64": ("decimal",),
    "date": ("timestamp_ntz", "timestamp"),
    "timestamp_ntz": ("timestamp",),
}
_NO_TEXT = {"array", "json"}


def can_widen(source: str, target: str) -> bool:
    """Whether every value of one kind has a place in the other."""
    if source == target:
        return True
    if target == "json":
        return True
    if target == "string":
        return source not in _NO_TEXT
    return target in _WIDER.get(source, ())


def widened(a: Column, b: Column) -> Column:
    """The narrowest column that takes the values of both; the name is that of ``b``."""
    if a.kind == b.kind == "decimal":
        scale = max(a.scale, b.scale)
        digits = max((a.precision or 38) - a.scale, (b.precision or 38) - b.scale)
        if digits + scale > 38:
            raise ValueError(f"column {b.name}: decimal({digits + scale},{scale}) is beyond 38 digits")
        return Column(b.name, "decimal", b.nullable, digits + scale, scale)
    if a.kind == b.kind == "string":
        bounded = a.max_length and b.max_length
        return Column(b.name, "string", b.nullable, max_length=max(a.max_length, b.max_length) if bounded else 0)
    if a.kind == b.kind:
        return b
    if {a.kind, b.kind} <= {*FLOATS, "decimal"}:  # exact and inexact numbers meet in text
        kind = "string" if "decimal" in (a.kind, b.kind) else "float64"
        return Column(b.name, kind, b.nullable)
    for source, target in ((a, b), (b, a)):
        if can_widen(source.kind, target.kind):
            return Column(b.name, target.kind, b.nullable, target.precision, target.scale)
    both_text = can_widen(a.kind, "string") and can_widen(b.kind, "string")
    return Column(b.name, "string" if both_text else "json", b.nullable)
