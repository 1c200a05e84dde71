"""Where patterns occur in texts, in SQL functions: spans counted in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPANS)


def with_spans(df: DataFrame, name: str, pattern: str, likely: Column | None = None) -> DataFrame:
    """Add ``name``: the leftmost non-overlapping matches of ``pattern`` in ``text``.

    The pieces between the matches and the matches alternate, so their lengths add up to the places. ``likely``
    is a cheap condition that every text with a match meets. Steps are columns of their own, as an expression
    inside another's function would run for each element.
    """
    hit = F.col("text").rlike(pattern) if likely is None else likely & F.col("text").rlike(pattern)
    found, size = F.col(f"_{name}"), F.size(f"_{name}")
    pieces = F.when(size > 0, F.split("text", pattern, -1))
    step = df.withColumn(f"_{name}", F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    pairs = F.arrays_zip(found.alias("m"), F.slice(pieces, 1, size).alias("p"))
    start = F.struct(F.lit(0).alias("at"), none().alias("spans"))

    def grown(state: Column, pair: Column) -> Column:
        first = state["at"] + F.char_length(pair["p"])
        last = first + F.char_length(pair["m"])
        return F.struct(
            last.alias("at"),
            F.concat(state["spans"], F.array(F.struct(first.alias("start"), last.alias("end"), pair["m"].alias("value")))).alias("spans"),
        )

    step = step.withColumn(f"_{name}_pairs", F.when(size > 0, pairs.cast("array<struct<m:string,p:string>>")))
    return step.withColumn(
        name, F.when(size > 0, F.aggregate(f"_{name}_pairs", start, grown, lambda s: s["spans"])).otherwise(none())
    ).drop(f"_{name}", f"_{name}_pairs")


def kept(df: DataFrame, name: str, keep: Callable[[Column], Column]) -> DataFrame:
    """Drop the spans of ``name`` whose value fails ``keep``."""
    return df.withColumn(name, F.when(F.size(name) > 0, F.filter(name, lambda s: keep(s["value"]))).otherwise(F.col(name)))


def labelled(names: list[str]) -> Column:
    """The spans of the named columns as one array of (start, kind, end, label), in no order yet."""
    kind = "array<struct<start:int,kind:int,end:int,label:string>>"

    def part(k: int, name: str) -> Column:
        return F.transform(
            name, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), F.lit(name).alias("label"))
        ).cast(kind)

    parts = [part(k, name) for k, name in enumerate(names)]
    return F.concat(*parts)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, in the given order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, spans: Column, put: Callable[[Column], Column]) -> Column:
    """``text`` with each span of the sorted ``spans`` replaced by ``put(span)``; what lies under an earlier one goes with it."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def grown(state: Column, s: Column) -> Column:
        new = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(new, F.concat(state["out"], gap, put(s))).otherwise(state["out"]).alias("out")
        )

    rest = F.aggregate(spans, start, grown, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.lit(2**31 - 1))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
