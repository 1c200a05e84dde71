"""Allowed differences, as column expressions over the compared values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.canon import number_text

Tolerance = str | int | float | Decimal | None
# one digit short of 38, so that a difference still fits; with the texts that each holds unchanged
EXACT = {
    "decimal(37,9)": r"^-?[0-9]{1,28}([.][0-9]{1,9})?$",
    "decimal(37,20)": r"^-?[0-9]{1,17}([.][0-9]{1,20})?$",
    "decimal(37,33)": r"^-?[0-9]{1,4}([.][0-9]{1,33})?$",
}


def allowed(tolerance: Tolerance, base: Column) -> Column:
    """Absolute difference allowed: a number as it stands, ``"x%"`` as that share of ``base``."""
    text = "0" if tolerance is None else str(tolerance).strip()
    if text.endswith("%"):
        share = Decimal(text[:-1].strip()) / 100
        return F.abs(F.coalesce(base.cast("double"), F.lit(0.0))) * F.lit(float(share))
    return F.lit(float(Decimal(text)))


def close_numbers(s: Column, t: Column, limit: Column) -> Column:
    """Two texts of ``number_text`` are equal, or apart by at most a limit above 0; the difference is taken as in ``within``."""
    apart = F.abs(s.try_cast("double") - t.try_cast("double"))
    for kind, texts in EXACT.items():
        fits = s.rlike(texts) & t.rlike(texts)
        apart = F.when(fits, F.abs(s.try_cast(kind) - t.try_cast(kind)).cast("double")).otherwise(apart)
    return (s == t) | ((limit > 0) & (apart <= limit))


def within(source: Column, target: Column, tolerance: Tolerance) -> Column:
    """|source - target| within the tolerance of the source; equality where one is NULL or no number.

    Equal digits are within any tolerance, and without a tolerance nothing else is. The difference is taken as decimals
    where both sides fit them unchanged, and as doubles elsewhere.
    """
    both = F.struct(number_text(source.cast("string")).alias("s"), number_text(target.cast("string")).alias("t"))
    same = source.cast("string").eqNullSafe(target.cast("string"))
    limit = allowed(tolerance, source.try_cast("double"))

    def judged(x: Column) -> Column:
        return F.when(x["s"].isNull() | x["t"].isNull(), same).otherwise(close_numbers(x["s"], x["t"], limit))

    return F.get(F.transform(F.array(both), judged), F.lit(0))


def terms(tolerance: Tolerance) -> tuple[float, float]:
    """A tolerance as (absolute, share): ``absolute + share * |base|`` is what ``allowed`` gives."""
    text = "0" if tolerance is None else str(tolerance).strip()
    if text.endswith("%"):
        return 0.0, float(Decimal(text[:-1].strip()) / 100)
    return float(Decimal(text)), 0.0


def within_seconds(source: Column, target: Column, seconds: Column) -> Column:
    """Instants equal to the second, or apart by at most ``seconds``."""
    s, t = F.unix_seconds(source.cast("timestamp")), F.unix_seconds(target.cast("timestamp"))
    return F.when(s.isNull() | t.isNull(), s.eqNullSafe(t)).otherwise(F.abs(s - t) <= seconds)


def ratio_holds(a: Column, b: Column, operator: str, factor: float = 1.0) -> Column:
    """``b OP a * factor`` with OP one of <=, <, >=, >."""
    limit = a * F.lit(factor)
    conditions = {"<=": b <= limit, "<": b < limit, ">=": b >= limit, ">": b > limit}
    return conditions[operator]


def drifted(current: Column, baseline: Column, tolerance: Tolerance) -> Column:
    """True when ``current`` grew beyond the baseline and its tolerance."""
    return current.cast("double") > baseline.cast("double") + allowed(tolerance, baseline)
