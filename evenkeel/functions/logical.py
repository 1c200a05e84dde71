"""Logical types that hold across warehouses, and the mapping from legacy to target types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Scalar spellings of either warehouse and the Spark type each one means.
SPELLINGS = {
    "tinyint": "bigint",
    "smallint": "bigint",
    "int": "bigint",
    "integer": "bigint",
    "bigint": "bigint",
    "int64": "bigint",
    "float": "double",
    "double": "double",
    "double precision": "double",
    "real": "double",
    "float64": "double",
    "string": "string",
    "varchar": "string",
    "char": "string",
    "text": "string",
    "binary": "binary",
    "bytes": "binary",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp",
    "datetime": "timestamp_ntz",
    "date": "date",
    "time": "string",
    "json": "string",
}
DECIMAL_WORDS = r"(?i)\b(decimal|numeric|bignumeric)\b"


def lacks_scale(declared: str | T.DataType) -> bool:
    """True for a decimal declaration that names no scale."""
    return isinstance(declared, str) and bool(re.fullmatch(DECIMAL_WORDS + r"\s*(\(\s*\d+\s*\))?", declared.strip()))


# Nested kinds that may be declared without their inner types.
OUTER_KINDS = {"array": "array<string>", "struct": "struct<>", "record": "struct<>", "map": "map<string,string>"}


def is_outer_kind(declared: str | T.DataType) -> bool:
    """True for a nested declaration that leaves its inner types open."""
    return isinstance(declared, str) and declared.strip().lower() in OUTER_KINDS


def spark_type(declared: str | T.DataType) -> T.DataType:
    """A declared type as a Spark type; nested types are written as Spark DDL."""
    if isinstance(declared, T.DataType):
        return declared
    text = declared.strip()
    if lacks_scale(text):
        return T.DecimalType(38, 9)
    scalar = OUTER_KINDS.get(text.lower()) or SPELLINGS.get(re.sub(r"\(.*\)$", "", text).strip().lower())
    return T.DataType.fromDDL(scalar or re.sub(DECIMAL_WORDS, "decimal", text))


def logical_name(dtype: T.DataType) -> str:
    """INT64, FLOAT64, NUMERIC, STRING, ... of a Spark type."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    if isinstance(dtype, T.StringType):
        return "STRING"
    names = {
        T.DecimalType: "NUMERIC",
        T.BinaryType: "BYTES",
        T.BooleanType: "BOOL",
        T.TimestampType: "TIMESTAMP",
        T.TimestampNTZType: "DATETIME",
        T.DateType: "DATE",
        T.ArrayType: "ARRAY",
        T.StructType: "STRUCT",
        T.MapType: "MAP",
    }
    return names.get(type(dtype), dtype.typeName().upper())


def signature(dtype: T.DataType) -> str:
    """Canonical nested signature, e.g. ``ARRAY<STRUCT<a:INT64,b:STRING>>``."""
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{signature(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<{signature(dtype.keyType)},{signature(dtype.valueType)}>"
    if isinstance(dtype, T.StructType):
        fields = ",".join(f"{f.name.lower()}:{signature(f.dataType)}" for f in dtype.fields)
        return f"STRUCT<{fields}>"
    return logical_name(dtype)


def types_agree(expected: T.DataType, actual: T.DataType) -> bool:
    """Same signature, and for decimals the same scale; the precision may widen."""
    if isinstance(expected, T.DecimalType) and isinstance(actual, T.DecimalType):
        return expected.scale == actual.scale
    return signature(expected) == signature(actual)


def target_type(legacy: T.DataType) -> T.DataType:
    """Target type of a legacy type: wide numbers, and maps as arrays of key/value structs."""
    if isinstance(legacy, T.MapType):
        pair = T.StructType([
            T.StructField("key", target_type(legacy.keyType)),
            T.StructField("value", target_type(legacy.valueType)),
        ])
        return T.ArrayType(pair)
    if isinstance(legacy, T.ArrayType):
        return T.ArrayType(target_type(legacy.elementType))
    if isinstance(legacy, T.StructType):
        return T.StructType([T.StructField(f.name.lower(), target_type(f.dataType)) for f in legacy.fields])
    widened = {"INT64": T.LongType(), "FLOAT64": T.DoubleType(), "STRING": T.StringType()}
    return widened.get(logical_name(legacy), legacy)
