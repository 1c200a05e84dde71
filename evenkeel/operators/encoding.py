"""Epoch and decimal columns checked key by key after a migration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canon import column, number_text, type_of
from evenkeel.functions.scalars import epoch_to_timestamp
from evenkeel.operators.checks import to_checks, union_all
from evenkeel.operators.localize import aligned

GOOD_CLASSES = ("matched", "nulled", "null_source")


@dataclass(frozen=True)
class EpochRule:
    """How a raw epoch column should have been converted."""

    unit: str
    expect_years: tuple[int, int] = (1970, 9999)
    sane_years: tuple[int, int] = (1970, 2100)
    out_of_range_is_null: bool = True


def classify_epochs(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    raw: str,
    converted: str,
    rule: EpochRule,
) -> DataFrame:
    """(key..., raw, expected, actual, class) for every key of either side.

    Classes: matched, nulled (out of range and NULL as it should be), null_source, and the
    faults should_be_null, lying_column (the year is outside the expected ones), mismatch,
    only_target, duplicate_key.
    """
    both = aligned(source, target, key, {"raw": column(raw)}, {"ts": column(converted).cast("timestamp")})
    instant = epoch_to_timestamp(F.col("s_raw"), rule.unit)
    year = F.year(instant)
    sane = F.coalesce(year.between(*rule.sane_years), F.lit(False))
    actual = F.col("t_ts")
    bad_null = actual.isNotNull() & F.lit(rule.out_of_range_is_null)
    kind = (
        F.when(F.col("s_n") == 0, "only_target")
        .when((F.col("s_n") > 1) | (F.col("t_n") > 1), "duplicate_key")
        .when(F.col("s_raw").isNull() & actual.isNull(), "null_source")
        .when(F.col("s_raw").isNull(), "should_be_null")
        .when(~sane & bad_null, "should_be_null")
        .when(~sane, "nulled")
        .when(~year.between(*rule.expect_years), "lying_column")
        .when(F.date_trunc("second", instant) == F.date_trunc("second", actual), "matched")
        .otherwise("mismatch")
    )
    return both.select(
        *key, F.col("s_raw").alias("raw"), instant.alias("expected"), actual.alias("actual"), kind.alias("class")
    )


def epoch_conversion(
    name: str,
    classified: DataFrame,
    report_only_target: bool = True,
    audit: DataFrame | None = None,
    audit_filter: Column | str | None = None,
) -> DataFrame:
    """Summary check over ``classify_epochs`` rows; with ``audit``, also one on its row count."""
    good = F.col("class").isin(*GOOD_CLASSES)
    if not report_only_target:
        good = good | (F.col("class") == "only_target")
    out_of_range = F.col("class").isin("nulled", "should_be_null") & F.col("raw").isNotNull()
    summary = classified.agg(
        F.count_if(F.col("class") == "matched").alias("matched"),
        F.count_if(out_of_range).alias("nulled"),
        F.count_if(~good).alias("bad"),
    )
    main = to_checks(
        summary,
        "epoch_conversion",
        name,
        F.col("bad") == 0,
        F.format_string("%s matched, %s out of range, %s bad", "matched", "nulled", "bad"),
        "0",
        F.col("bad"),
        {"matched": F.col("matched"), "nulled": F.col("nulled"), "mismatched": F.col("bad")},
    )
    if audit is None:
        return main
    rows = audit if audit_filter is None else audit.where(audit_filter)
    counts = summary.select("nulled", F.lit(None).cast("bigint").alias("audited")).unionByName(
        rows.agg(F.count(F.lit(1)).alias("audited")).select(F.lit(None).cast("bigint").alias("nulled"), "audited")
    ).agg(F.max("nulled").alias("nulled"), F.max("audited").alias("audited"))
    audited = to_checks(
        counts.where(F.col("nulled") > 0),
        "epoch_conversion",
        f"{name} (audit)",
        F.col("audited") >= F.col("nulled"),
        F.format_string("%s audit rows for %s epochs out of range", "audited", "nulled"),
        F.col("nulled"),
        F.col("audited"),
    )
    return union_all([main, audited])


def _always_fits(df: DataFrame, name: str) -> bool:
    """True for a type whose every value fits decimal(38,18), so that no text is needed."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.DecimalType):
        return dtype.scale <= 18 and dtype.precision - dtype.scale <= 20
    return isinstance(dtype, T.IntegralType)


def decimal_differences(
    source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """(key..., column, source_value, target_value, reason) where a value changed.

    1.50 equals 1.5, and every digit counts: a value that decimal(38,18) may not hold is compared by the text of all its
    digits. Reasons: value, unparseable (text that is no number, unless both sides
    hold the same text), only_source, only_target, duplicate_key.
    """
    plain = {c for c in columns if _always_fits(source, c) and _always_fits(target, c)}
    values = []
    for df in (source, target):
        mine = {}
        for i, c in enumerate(columns):
            mine[f"n{i}"] = column(c).try_cast("decimal(38,18)")
            if c not in plain:
                digits = number_text(column(c).cast("string"))
                mine[f"x{i}"] = F.coalesce(digits, column(c).cast("string"))
                mine[f"y{i}"] = digits.isNotNull()
        values.append(mine)
    both = aligned(source, target, key, *values)
    entries = []
    for i, c in enumerate(columns):
        nothing = F.lit(None).cast("string")
        if c in plain:
            s_text = t_text = nothing
            unparsed, changed = F.lit(False), ~F.col(f"s_n{i}").eqNullSafe(F.col(f"t_n{i}"))
        else:
            s_text, t_text = F.col(f"s_x{i}"), F.col(f"t_x{i}")
            changed = ~s_text.eqNullSafe(t_text)
            words = (s_text.isNotNull() & ~F.col(f"s_y{i}")) | (t_text.isNotNull() & ~F.col(f"t_y{i}"))
            unparsed = changed & words
        reason = (
            F.when((F.col("s_n") > 1) | (F.col("t_n") > 1), "duplicate_key")
            .when(F.col("s_n") == 0, "only_target")
            .when(F.col("t_n") == 0, "only_source")
            .when(unparsed, "unparseable")
            .when(changed, "value")
        )
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(s_text, F.col(f"s_n{i}").cast("string")).alias("source_value"),
                F.coalesce(t_text, F.col(f"t_n{i}").cast("string")).alias("target_value"),
                reason.alias("reason"),
            )
        )
    return both.select(*key, F.inline(F.array(*entries))).where(F.col("reason").isNotNull())


def decimal_roundtrip(name: str, differences: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One check per column with its own number of differences."""
    counts = differences.agg(*[F.count_if(F.col("column") == c).alias(f"n{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n")) for i, c in enumerate(columns)]
    return to_checks(
        counts.select(F.inline(F.array(*entries))),
        "decimal_roundtrip",
        F.concat(F.lit(f"{name}."), F.col("column")),
        F.col("n") == 0,
        F.concat(F.col("n").cast("string"), F.lit(" differences")),
        "0",
        F.col("n"),
    )
