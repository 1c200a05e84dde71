"""Guarded conversions that answer NULL where the plain function would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-01 and of the last second of 9999.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799
PER_SECOND = {"seconds": 1, "millis": 1_000, "micros": 1_000_000}


def epoch_to_timestamp(raw: Column, unit: str) -> Column:
    """Epoch number to instant; NULL outside the years 1 to 9999."""
    per_second = PER_SECOND[unit]
    value = raw.try_cast("bigint")
    inside = value.between(FIRST_SECOND * per_second, LAST_SECOND * per_second + per_second - 1)
    convert = {"seconds": F.timestamp_seconds, "millis": F.timestamp_millis, "micros": F.timestamp_micros}[unit]
    return F.when(inside, convert(F.when(inside, value)))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def floor_millis(raw: Column) -> Column:
    """Whole seconds of an epoch in milliseconds, rounded down."""
    return F.floor(raw / F.lit(1000)).cast("bigint")


def compact_timestamp(text: Column) -> Column:
    """``yyyyMMddHHmmss`` text to timestamp."""
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text or number to date."""
    return F.try_to_timestamp(text.cast("string"), F.lit("yyyyMMdd")).cast("date")


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` of a date as a number."""
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_date(text: Column) -> Column:
    return F.when(F.length(text) == 10, text.try_cast("date"))


def iso_timestamp(text: Column) -> Column:
    """ISO text with a time part to instant; a zone suffix is honoured, none means UTC."""
    return F.when(text.contains("T") | (text.contains(":") & text.contains("-")), text.try_cast("timestamp"))


def regex_group(text: Column, pattern: str, group: int = 1) -> Column:
    """A capture group, NULL when the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), F.nullif(whole, F.lit(0)).cast("double")) * 100


def pick(items: list[str], position: Column) -> Column:
    """Item at a zero-based position."""
    return F.element_at(F.array(*[F.lit(i) for i in items]), (position + 1).cast("int"))


def map_to_entries(col: Column) -> Column:
    """MAP to ARRAY<STRUCT<key, value>>."""
    return F.map_entries(col)


def md5_of(columns: list[Column], separator: str = "|", null_text: str = "None") -> Column:
    """MD5 of joined texts; a NULL is written out, not skipped."""
    return F.md5(F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in columns]))
