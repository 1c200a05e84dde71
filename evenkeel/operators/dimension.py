"""Slowly changing dimensions: build versions, and check that a timeline is sound."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canon import column, type_of
from evenkeel.functions.scalars import md5_of
from evenkeel.operators.checks import to_checks
from evenkeel.operators.ordered import ROWS_PER_CHUNK, find_cuts, latest_per_key, with_next, with_previous

TERMINAL = "9999-12-31"


@dataclass(frozen=True)
class Timeline:
    """Names of the columns that make a version table."""

    entity: str
    eff_from: str
    eff_to: str
    current: str
    terminal: str = TERMINAL
    row_hash: str | None = None
    hash_columns: tuple[str, ...] = ()


def _printed(df: DataFrame, name: str) -> Column:
    dtype = type_of(df, name)
    col = column(name)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, "True").when(~col, "False")
    if isinstance(dtype, (T.IntegralType, T.StringType, T.DecimalType, T.DateType)):
        return col.cast("string")
    raise TypeError(f"{name}: a {dtype.simpleString()} column has no fixed text form for a row hash")


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """MD5 of the columns' texts joined by a pipe; NULL prints as ``None``."""
    return md5_of([_printed(df, c) for c in columns])


def row_hash_mismatches(df: DataFrame, stored: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose stored hash is not the recomputed one."""
    computed = df.withColumn("computed_hash", row_hash(df, columns))
    return computed.where(~column(stored).eqNullSafe(F.col("computed_hash")))


def _judged(df: DataFrame, t: Timeline, rows_per_chunk: int) -> DataFrame:
    """Rows with a flag per rule: gap, open (ends on the terminal date), bad_hash."""
    second = lambda c: F.date_trunc("second", c.cast("timestamp"))
    hashed = t.row_hash is not None and len(t.hash_columns) > 0
    bad_hash = ~column(t.row_hash).eqNullSafe(row_hash(df, t.hash_columns)) if hashed else F.lit(False)
    rows = df.select(
        t.entity,
        t.eff_from,
        t.eff_to,
        F.coalesce(column(t.current), F.lit(False)).alias("_current"),
        column(t.eff_to).cast("date").eqNullSafe(F.lit(t.terminal).cast("date")).alias("_open"),
        bad_hash.alias("_bad_hash"),
        (column(t.row_hash) if hashed else F.lit(None).cast("string")).alias("_stored"),
        F.lit(True).alias("_has_next"),
    )
    chained = with_next(
        rows,
        [t.entity],
        [t.eff_from, t.eff_to],
        {"_next_from": t.eff_from, "_next": "_has_next"},
        find_cuts(rows, [t.entity], [t.eff_from, t.eff_to], rows_per_chunk),
    )
    gap = F.coalesce("_next", F.lit(False)) & ~second(column(t.eff_to)).eqNullSafe(second(F.col("_next_from")))
    return chained.withColumn("_gap", gap)


def _per_entity(judged: DataFrame, t: Timeline) -> DataFrame:
    return judged.groupBy(column(t.entity).alias("entity")).agg(
        F.count_if("_gap").alias("gap"),
        F.count_if("_current").alias("n_current"),
        F.count_if(F.col("_current") & ~F.col("_open")).alias("closed_current"),
        F.count_if(~F.col("_current") & F.col("_open")).alias("open_closed"),
        F.count_if("_bad_hash").alias("row_hash"),
    )


def timeline_violations(df: DataFrame, t: Timeline, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(entity, rule, detail) per violation.

    Rules: gap (a version does not end where the next one begins), current (not exactly one
    current version), terminal (the current version does not end on the terminal date, or a
    closed one does), row_hash.
    """
    judged = _judged(df, t, rows_per_chunk)

    def found(condition: Column, rule: str, detail: Column) -> Column:
        return F.when(condition, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))

    hop = F.concat_ws(" -> ", column(t.eff_to).cast("string"), F.col("_next_from").cast("string"))
    row_level = F.array(
        found(F.col("_gap"), "gap", hop),
        found(~F.col("_current") & F.col("_open"), "terminal", F.lit("closed version is open-ended")),
        found(F.col("_bad_hash"), "row_hash", F.col("_stored")),
    )
    entity_level = F.array(
        found(F.col("n_current") != 1, "current", F.col("n_current")),
        found((F.col("n_current") == 1) & (F.col("closed_current") > 0), "terminal", F.lit("current version is closed")),
    )
    by_row = judged.select(column(t.entity).alias("entity"), F.inline(F.array_compact(row_level)))
    by_entity = _per_entity(judged, t).select("entity", F.inline(F.array_compact(entity_level)))
    return by_row.unionByName(by_entity)


def scd2_continuity(name: str, df: DataFrame, t: Timeline, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """One check per rule with its number of violations, from one pass over the versions."""
    one_current = F.col("n_current") == 1
    counts = {
        "gap": F.sum("gap"),
        "current": F.count_if(~one_current),
        "terminal": F.sum(F.col("open_closed") + F.when(one_current, F.col("closed_current")).otherwise(0)),
    }
    if t.row_hash and t.hash_columns:
        counts["row_hash"] = F.sum("row_hash")
    zero = F.lit(0).cast("bigint")
    folded = _per_entity(_judged(df, t, rows_per_chunk), t).agg(
        *[F.coalesce(v, zero).alias(f"{k}_n") for k, v in counts.items()]
    )
    per_rule = folded.select(
        F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"{r}_n").alias("n")) for r in counts]))
    )
    return to_checks(
        per_rule,
        "scd2_continuity",
        F.concat(F.lit(f"{name}:"), F.col("rule")),
        F.col("n") == 0,
        F.concat(F.col("n").cast("string"), F.lit(" violations")),
        "0",
        F.col("n"),
    )


def build_versions(
    changes: DataFrame,
    entity: str,
    changed_at: str,
    tracked: Sequence[str],
    tie_break: Sequence[str] = (),
    terminal: str = TERMINAL,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Versions of an entity from its change rows: (entity, tracked..., eff_from, eff_to, is_current, row_hash).

    Rows that repeat the tracked values of the row before start no version. Of several rows at
    one instant the last in ``tie_break`` order counts.
    """
    order = [F.col(c).desc_nulls_last() for c in tie_break] or [column(c).desc_nulls_last() for c in tracked]
    needed = list(dict.fromkeys([entity, changed_at, *tracked, *tie_break]))
    last = latest_per_key(changes.select(*needed), [entity, changed_at], order)
    hashed = last.select(entity, changed_at, *tracked).withColumn("row_hash", row_hash(last, [entity, *tracked]))
    cuts = find_cuts(changes, [entity], changed_at, rows_per_chunk)
    stepped = with_previous(hashed, [entity], [changed_at], {"_before": "row_hash"}, cuts)
    starts = stepped.where(~F.col("_before").eqNullSafe(F.col("row_hash"))).drop("_before")
    ended = with_next(starts, [entity], [changed_at], {"_until": changed_at}, cuts)
    until = F.coalesce(F.col("_until").cast("timestamp"), F.lit(terminal).cast("timestamp"))
    return ended.select(
        entity,
        *tracked,
        column(changed_at).cast("timestamp").alias("eff_from"),
        until.alias("eff_to"),
        F.col("_until").isNull().alias("is_current"),
        "row_hash",
    )
