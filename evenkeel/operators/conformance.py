"""Does a frame fit a declared schema, in its metadata and in its values; and making it fit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import scalars
from evenkeel.functions.canon import column, number_text, type_of
from evenkeel.functions.logical import is_outer_kind, lacks_scale, logical_name, signature, spark_type, target_type, types_agree
from evenkeel.operators.checks import to_checks, union_all


@dataclass(frozen=True)
class ExpectedColumn:
    """A declared column; ``type`` is a Spark type, Spark DDL or a warehouse spelling."""

    name: str
    type: str | T.DataType
    nullable: bool = True
    source_name: str | None = None
    source_type: str | T.DataType | None = None


def _type_text(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"NUMERIC({dtype.precision},{dtype.scale})"
    return signature(dtype)


def _loses_digits(col: Column, dtype: T.DataType, scale: int) -> Column | None:
    """Whether a number has more digits after its point than ``scale``, however many it has."""
    if isinstance(dtype, T.DecimalType):
        return None if dtype.scale <= scale else col != F.round(col, scale)
    if not isinstance(dtype, (T.FloatType, T.DoubleType, T.StringType)):
        return None
    text = number_text(col.cast("string"))
    return text.contains(".") & (F.length(F.substring_index(text, ".", -1)) > scale)


def _static(name: str, rule: str, passed: bool, expected: str | None, actual: str | None) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(rule).alias("rule"),
        F.lit(0 if passed else 1).cast("bigint").alias("bad"),
        F.lit(expected).cast("string").alias("expected"),
        F.lit(actual).cast("string").alias("actual"),
    )


def conformance_profile(df: DataFrame, expected: Sequence[ExpectedColumn], scan_values: bool = True) -> DataFrame:
    """(column, rule, bad, expected, actual): one row per rule, all values read in one pass.

    Metadata rules: present, type, declared_scale. Value rules: not_null (NULLs in a required
    column), convertible (values that do not survive the cast), scale (values with more digits
    than declared) and element_not_null (NULL elements of an array).
    """
    static, counted, labels = [], [], []

    def count(name: str, rule: str, bad: Column, wanted: str) -> None:
        counted.append(F.count_if(bad).alias(f"c{len(counted)}"))
        labels.append((name, rule, wanted))

    for want in expected:
        dtype = type_of(df, want.name)
        wanted = spark_type(want.type)
        if dtype is None:
            hint = f"expected as a rename of {want.source_name}" if want.source_name else None
            static.append(_static(want.name, "present", False, _type_text(wanted), hint))
            continue
        static.append(_static(want.name, "present", True, _type_text(wanted), _type_text(dtype)))
        unscaled = lacks_scale(want.type)
        if unscaled:
            static.append(_static(want.name, "declared_scale", False, "a scale", str(want.type)))
        shallow = unscaled or is_outer_kind(want.type)
        agree = logical_name(wanted) == logical_name(dtype) if shallow else types_agree(wanted, dtype)
        static.append(_static(want.name, "type", agree, _type_text(wanted), _type_text(dtype)))
        if not scan_values:
            continue
        col = column(want.name)
        if not want.nullable:
            count(want.name, "not_null", col.isNull(), "0")
        scalar = not isinstance(wanted, (T.ArrayType, T.MapType, T.StructType))
        nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
        if scalar and not nested and type(wanted) is not type(dtype):
            count(want.name, "convertible", col.isNotNull() & col.try_cast(wanted).isNull(), "0")
        if isinstance(wanted, T.DecimalType):
            lost = _loses_digits(col, dtype, wanted.scale)
            if lost is not None:
                count(want.name, "scale", lost, "0")
        if isinstance(dtype, T.ArrayType):
            count(want.name, "element_not_null", F.exists(col, lambda x: x.isNull()), "0")
    entries = F.array(*static)
    if not counted:
        return df.sparkSession.range(1).select(F.inline(entries))
    values = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(rule).alias("rule"),
            F.col(f"c{i}").alias("bad"),
            F.lit(wanted).alias("expected"),
            F.col(f"c{i}").cast("string").alias("actual"),
        )
        for i, (name, rule, wanted) in enumerate(labels)
    ]
    row = df.agg(*counted)
    return row.select(F.inline(F.concat(entries, F.array(*values))))


Counter = Callable[[Column], Column]


def _one(bad: Column) -> Column:
    return F.when(bad, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _each(count: Counter, entries: Counter = lambda c: c) -> Counter:
    """The sum of ``count`` over the elements of an array, or over the ``entries`` made of a value."""
    return lambda c: F.coalesce(F.aggregate(entries(c), F.lit(0).cast("bigint"), lambda n, x: n + count(x)), F.lit(0).cast("bigint"))


def _field(count: Counter, name: str) -> Counter:
    """``count`` of a field; a NULL struct has no fields to judge."""
    return lambda c: F.when(c.isNotNull(), count(c.getField(name))).otherwise(F.lit(0).cast("bigint"))


def _loses_inside(col: Column, dtype: T.DataType, scale: int) -> Column | None:
    """``_loses_digits`` that spells a number out only where its text is not plain digits; here no code is compiled."""
    lost = _loses_digits(col, dtype, scale)
    if lost is None or isinstance(dtype, T.DecimalType):
        return lost
    text = col.cast("string")
    after = F.length(F.rtrim(F.substring_index(text, ".", -1), F.lit("0")))
    return F.when(text.rlike(r"^[0-9]+\z"), F.lit(False)).when(text.rlike(r"^-?[0-9]+\.[0-9]+\z"), after > scale).otherwise(lost)


def _counters(dtype: T.DataType, wanted: T.DataType, path: str, required: bool) -> list[tuple[str, str, Counter]]:
    """(path, rule, counter of bad values) for a value and all values inside it, as far as both types have the shape."""
    found = [(path, "not_null", lambda c: _one(c.isNull()))] if required else []
    if isinstance(dtype, T.MapType) and isinstance(wanted, T.ArrayType):
        pair = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        inner = _counters(pair, wanted.elementType, f"{path}[]", False)
        found += [(p, rule, _each(count, F.map_entries)) for p, rule, count in inner]
    elif isinstance(dtype, T.ArrayType) and isinstance(wanted, T.ArrayType):
        inner = _counters(dtype.elementType, wanted.elementType, f"{path}[]", True)
        found += [(p, rule, _each(count)) for p, rule, count in inner]
    elif isinstance(dtype, T.MapType) and isinstance(wanted, T.MapType):
        keys = _counters(dtype.keyType, wanted.keyType, f"{path}{{key}}", False)
        values = _counters(dtype.valueType, wanted.valueType, f"{path}{{value}}", not wanted.valueContainsNull)
        found += [(p, rule, _each(count, F.map_keys)) for p, rule, count in keys]
        found += [(p, rule, _each(count, F.map_values)) for p, rule, count in values]
    elif isinstance(dtype, T.StructType) and isinstance(wanted, T.StructType):
        named = {f.name.lower(): f for f in dtype.fields}
        for want in wanted.fields:
            if own := named.get(want.name.lower()):
                inner = _counters(own.dataType, want.dataType, f"{path}.{want.name}", not want.nullable)
                found += [(p, rule, _field(count, own.name)) for p, rule, count in inner]
    elif not any(isinstance(t, (T.ArrayType, T.MapType, T.StructType)) for t in (dtype, wanted)):
        if type(dtype) is not type(wanted):
            found.append((path, "convertible", lambda c: _one(c.isNotNull() & c.try_cast(wanted).isNull())))
        if isinstance(wanted, T.DecimalType) and _loses_inside(F.lit(None).cast(dtype), dtype, wanted.scale) is not None:
            found.append((path, "scale", lambda c: _one(_loses_inside(c, dtype, wanted.scale))))
    return found


def nested_profile(df: DataFrame, expected: Sequence[ExpectedColumn]) -> DataFrame:
    """(column, rule, bad, expected, actual) for the values inside arrays, maps and structs, counted in one pass.

    ``column`` is a path: ``a[]`` the elements of an array, ``m{key}`` and ``m{value}`` those of a map, ``s.f`` a field. A
    map may be declared as an array of key and value structs. The rules are not_null (array elements, and fields declared
    NOT NULL), convertible and scale; bad counts values, not rows. Columns, fields and shapes that do not match are left
    to ``conformance_profile``.
    """
    counted, labels = [], []
    for want in expected:
        dtype = type_of(df, want.name)
        if not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)) or is_outer_kind(want.type):
            continue
        for path, rule, count in _counters(dtype, spark_type(want.type), want.name, not want.nullable):
            labels.append((path, rule))
            counted.append(F.coalesce(F.sum(count(column(want.name))), F.lit(0).cast("bigint")).alias(f"c{len(counted)}"))
    if not counted:
        return df.sparkSession.createDataFrame([], "column string, rule string, bad bigint, expected string, actual string")
    rows = [
        F.struct(
            F.lit(path).alias("column"),
            F.lit(rule).alias("rule"),
            F.col(f"c{i}").alias("bad"),
            F.lit("0").alias("expected"),
            F.col(f"c{i}").cast("string").alias("actual"),
        )
        for i, (path, rule) in enumerate(labels)
    ]
    return df.agg(*counted).select(F.inline(F.array(*rows)))


def source_mapping_profile(df: DataFrame, expected: Sequence[ExpectedColumn]) -> DataFrame:
    """The same profile on the legacy frame: declared source columns, their types, and the cast."""
    legacy = [
        ExpectedColumn(e.source_name or e.name, e.source_type if e.source_type is not None else e.type)
        for e in expected
    ]
    profile = conformance_profile(df, legacy, scan_values=False)
    casts = [
        ExpectedColumn(e.source_name or e.name, e.type) for e in expected if type_of(df, e.source_name or e.name)
    ]
    converted = conformance_profile(df, casts).where(F.col("rule").isin("convertible", "scale"))
    return profile.unionByName(converted)


def schema_conformance(name: str, profile: DataFrame) -> DataFrame:
    """One check per profile row."""
    return to_checks(
        profile,
        "schema_conformance",
        F.concat_ws(":", F.concat(F.lit(f"{name}."), F.col("column")), F.col("rule")),
        F.col("bad") == 0,
        F.concat_ws(" ", F.lit("expected"), "expected", F.lit("found"), "actual"),
        F.col("expected"),
        F.col("actual"),
        {"bad": F.col("bad")},
    )


@dataclass(frozen=True)
class ColumnMapping:
    """Where a target column comes from and how it is converted.

    ``how``: cast, epoch_seconds, epoch_millis, epoch_micros, compact_timestamp,
    compact_date, iso_date, iso_timestamp, date_of (the day of a converted timestamp),
    entries (map to array of key/value structs) or json_entries (the same from JSON text).
    """

    target: str
    source: str
    type: str | T.DataType | None = None
    how: str = "cast"


def _converted(df: DataFrame, m: ColumnMapping) -> Column:
    col = column(m.source)
    if m.how.startswith("epoch_"):
        return scalars.epoch_to_timestamp(col, m.how.removeprefix("epoch_"))
    by_name = {
        "compact_timestamp": scalars.compact_timestamp,
        "compact_date": scalars.compact_date,
        "iso_date": scalars.iso_date,
        "iso_timestamp": scalars.iso_timestamp,
        "date_of": lambda c: c.try_cast("date"),
        "entries": scalars.map_to_entries,
    }
    if m.how in by_name:
        return by_name[m.how](col)
    if m.how == "json_entries":
        return F.map_entries(F.from_json(col, m.type or "map<string,string>"))
    if m.how != "cast":
        raise ValueError(f"unknown conversion {m.how}")
    legacy = df.schema[m.source].dataType
    wanted = spark_type(m.type) if m.type is not None else target_type(legacy)
    if isinstance(legacy, T.MapType) and isinstance(wanted, T.ArrayType):
        return scalars.map_to_entries(col)
    return col.try_cast(wanted)


def conform(df: DataFrame, mapping: Sequence[ColumnMapping]) -> tuple[DataFrame, DataFrame]:
    """The frame in target types, and the rows that could not be converted.

    A row is quarantined, whole and as it came, when any value turns NULL in conversion;
    ``_failed`` names the target columns.
    """
    failed = [
        F.when(column(m.source).isNotNull() & _converted(df, m).isNull(), F.lit(m.target)) for m in mapping
    ]
    judged = df.withColumn("_failed", F.array_compact(F.array(*failed)))
    good = judged.where(F.size("_failed") == 0).select(*[_converted(df, m).alias(m.target) for m in mapping])
    return good, judged.where(F.size("_failed") > 0)


def profiles(parts: Sequence[tuple[str, DataFrame, Sequence[ExpectedColumn]]]) -> DataFrame:
    """Checks of several frames in one frame."""
    return union_all([schema_conformance(name, conformance_profile(df, want)) for name, df, want in parts])
