"""Canonical text of values: two values count as the same when their texts are equal.

``canonical`` is the exact form behind SHA-256 table digests. ``fast_canonical`` is a
cheaper form behind MD5 digests. Their bytes differ, so never compare one with the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# They are part of the hashed text.
NULL_TOKEN = "\x00__NULL__\x00"
NAN_TOKEN = "\x00NaN\x00"
INFINITY_TOKEN = "\x00Inf\x00"
NEGATIVE_INFINITY_TOKEN = "\x00-Inf\x00"
FIELD_SEPARATOR = "\x1f"
FLOAT_DECIMALS = 6
FAST_NULL = "__NULL__"
FAST_SEPARATOR = "~|~"

# sign, whole digits, fraction after whole digits, fraction alone, exponent
NUMBER = r"^([+-]?)(?:([0-9]+)[.]?([0-9]*)|[.]([0-9]+))(?:[eE]([+-]?[0-9]{1,4}))?$"


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType | None:
    """Type of a column, found ignoring case; None when the frame lacks it."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    return None


def trim_zeros(text: Column) -> Column:
    """Drop the trailing zeros, then a bare point, of a text that has a point."""
    return F.when(text.endswith("0"), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def decimal_text(col: Column, scale: int) -> Column:
    text = col.cast("string")
    return trim_zeros(text) if scale > 0 else text


def _shortest(x: Column) -> Column:
    """Scientific text with the fewest digits that read back as ``x``: 15, 16 or 17 of them.

    The JVM itself, before version 19, prints some doubles with more digits than needed.
    """
    texts = [F.format_string(f"%.{n}e", x) for n in (14, 15, 16)]
    return F.when(texts[0].cast("double") == x, texts[0]).when(texts[1].cast("double") == x, texts[1]).otherwise(texts[2])


def _written_out(scientific: Column) -> Column:
    """All digits of a scientific text whose exponent exceeds its digits."""
    digits = F.replace(F.substring_index(scientific, "e", 1), F.lit("."), F.lit(""))
    exponent = F.substring_index(scientific, "e", -1).cast("int")
    fraction = F.length(F.substring_index(F.substring_index(scientific, "e", 1), ".", -1))
    return F.concat(digits, F.repeat(F.lit("0"), exponent - fraction))


def _unusual_double_text(x: Column, decimals: int) -> Column:
    """Text of a NaN, an infinity or a double from 10**9 on."""
    fits = F.abs(x) < F.lit(10.0 ** (38 - decimals))  # false for NaN, which sorts above all
    return (
        F.when(fits, decimal_text(_shortest(x).cast(f"decimal(38,{decimals})"), decimals))
        .when(F.isnan(x), NAN_TOKEN)
        .when(x == F.lit(float("inf")), INFINITY_TOKEN)
        .when(x == F.lit(float("-inf")), NEGATIVE_INFINITY_TOKEN)
        .when(x.isNotNull(), _written_out(_shortest(x)))
    )


def double_text(col: Column, decimals: int) -> Column:
    """A float rounded half up at ``decimals``; where it has no room for a fraction, all its digits.

    Between 0.001 and 10**7 Spark prints a double plainly, so a short fraction needs no decimal.
    The unusual values go through an array function, which keeps their code out of the generated
    method: with them inside it would grow past what the JVM compiles.
    """
    x = col.cast("double")
    size = F.abs(x)
    printed = x.cast("string")
    short = F.instr(printed, ".") >= F.length(printed) - decimals
    plain = (size >= F.lit(1e-3)) & (size < F.lit(1e7)) & short
    whole = F.substring_index(printed, ".", 1)
    return (
        F.when(plain, F.when(printed.endswith(".0"), whole).otherwise(printed))
        .when(size < F.lit(1e9), decimal_text(x.cast(f"decimal(38,{decimals})"), decimals))
        .otherwise(F.get(F.transform(F.array(x), lambda v: _unusual_double_text(v, decimals)), F.lit(0)))
    )


def second_text(col: Column, dtype: T.DataType) -> Column:
    """Date and time to the second; an instant is read in UTC whatever the session's zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_trunc("second", col).cast("string")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(secs=F.unix_seconds(col).cast("decimal(18,6)"))).cast("string")


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def number_text(col: Column) -> Column:
    """All digits of the number a text spells, an exponent written out; NULL for any other text.

    1.50, +1.5 and 15e-1 give 1.5. Exponents have up to four digits.
    """
    zero = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)))

    def parts(s: Column) -> Column:
        group = lambda n: F.regexp_extract(s, NUMBER, n)
        shift = F.coalesce(group(5).try_cast("int"), F.lit(0))
        return F.struct(
            (group(1) == "-").alias("minus"), F.concat(group(2), group(3), group(4)).alias("digits"),
            (F.length(F.concat(group(2), F.lit(""))) + shift).alias("point"),
        )

    def padded(p: Column) -> Column:
        # as many zeros on either side as bring the point inside
        text = F.concat(zero(-p["point"]), p["digits"], zero(p["point"] - F.length(p["digits"])))
        return F.struct(p["minus"].alias("minus"), text.alias("text"), F.greatest(p["point"], F.lit(0)).alias("point"))

    def sides(p: Column) -> Column:
        before = F.ltrim(F.substring(p["text"], F.lit(1), p["point"]), F.lit("0"))
        after = F.rtrim(F.substring(p["text"], p["point"] + 1, F.length(p["text"])), F.lit("0"))
        return F.struct(p["minus"].alias("minus"), before.alias("before"), after.alias("after"))

    def joined(p: Column) -> Column:
        sign = F.when(p["minus"] & (F.length(p["before"]) + F.length(p["after"]) > 0), F.lit("-")).otherwise(F.lit(""))
        whole = F.when(p["before"] == "", F.lit("0")).otherwise(p["before"])
        return F.concat(sign, whole, F.when(p["after"] == "", F.lit("")).otherwise(F.concat(F.lit("."), p["after"])))

    def spelled(s: Column) -> Column:
        return F.when(s.rlike(NUMBER), _with(_with(_with(parts(s), padded), sides), joined))

    return _with(F.regexp_replace(col, r"^\s+|\s+$", ""), spelled)


def numeric_string_text(col: Column) -> Column:
    """A string that spells a number gets the number's text; any other stays as it is."""
    return F.coalesce(number_text(col), col)


def _struct_text(col: Column, dtype: T.StructType, decimals: int) -> Column:
    fields = sorted(dtype.fields, key=lambda f: f.name)
    parts = [
        F.concat(F.lit(f.name + ":"), canonical(col.getField(f.name), f.dataType, decimals)) for f in fields
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return F.when(col.isNull(), NULL_TOKEN).otherwise(text)


def canonical(
    col: Column, dtype: T.DataType, decimals: int = FLOAT_DECIMALS, numeric_strings: bool = False
) -> Column:
    """Exact canonical text of a column; never NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = double_text(col, decimals)
    elif isinstance(dtype, T.DecimalType):
        text = decimal_text(col, dtype.scale)
    elif isinstance(dtype, T.BinaryType):
        text = F.lower(F.hex(col))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = second_text(col, dtype)
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: canonical(x, dtype.elementType, decimals))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                canonical(e["key"], dtype.keyType, decimals).alias("k"),
                canonical(e["value"], dtype.valueType, decimals).alias("v"),
            ),
        )
        items = F.transform(F.array_sort(pairs), lambda e: F.concat(e["k"], F.lit(":"), e["v"]))
        text = F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))
    elif isinstance(dtype, T.StructType):
        return _struct_text(col, dtype, decimals)
    elif isinstance(dtype, T.StringType):
        text = numeric_string_text(col) if numeric_strings else col
    elif dtype.typeName() == "variant":
        text = F.to_json(col)
    elif dtype.typeName().startswith("time("):
        text = F.substring(col.cast("string"), 1, 8)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(NULL_TOKEN))


def row_text(
    df: DataFrame,
    columns: Sequence[str],
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
) -> Column:
    """Canonical text of a row in the given column order; a column the frame lacks is NULL."""
    parts = []
    for name in columns:
        dtype = type_of(df, name)
        missing = dtype is None
        parts.append(F.lit(NULL_TOKEN) if missing else canonical(column(name), dtype, decimals, numeric_strings))
    return F.concat_ws(FIELD_SEPARATOR, *parts)


def fast_canonical(col: Column, dtype: T.DataType) -> Column:
    """Cheap canonical text: decimals and floats as scaled integers; never NULL."""
    if isinstance(dtype, T.DecimalType):
        nano = col.try_cast("decimal(38,9)").cast("string")
        scaled = F.replace(nano, F.lit("."), F.lit("")).cast("decimal(38,0)").cast("string")
        text = F.coalesce(scaled, col.cast("string"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        x = col.cast("double")
        micro = F.round(x * F.lit(1e6))
        wide = F.coalesce(micro.try_cast("decimal(38,0)").cast("string"), x.cast("string"))
        text = F.when(F.abs(micro) < F.lit(9e18), micro.cast("bigint").cast("string")).otherwise(wide)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = second_text(col, dtype)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        text = F.when(col.isNotNull(), canonical(col, dtype))
    elif dtype.typeName() == "variant":
        text = F.to_json(col)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(FAST_NULL))


def fast_row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    parts = []
    for name in columns:
        dtype = type_of(df, name)
        parts.append(F.lit(FAST_NULL) if dtype is None else fast_canonical(column(name), dtype))
    return F.concat_ws(FAST_SEPARATOR, *parts)
