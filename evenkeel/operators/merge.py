"""Keyed merges as pure functions, and the checks that hold them to account."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import digest
from evenkeel.functions.canon import column
from evenkeel.operators.checks import side_by_side, to_checks
from evenkeel.operators.ordered import latest_per_key
from evenkeel.session import durable

DELETE = "D"


def _unique_delta(delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The delta with a guard that stops the job when a key occurs twice."""
    repeated = delta.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    n = repeated.agg(F.count(F.lit(1)).alias("_n")).scalar()
    message = F.raise_error(F.lit(f"delta holds a key more than once: {', '.join(keys)}"))
    return delta.where(F.when(n == 0, F.lit(True)).otherwise(message.cast("boolean")))


def apply_merge(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    check_unique: bool = True,
    with_action: bool = False,
) -> DataFrame:
    """Target after the delta: matched deletes and updates, unmatched inserts except deletes.

    Two joins rather than one full outer join, which Spark cannot split when a key is hot. The
    target's keys are not broadcast, however small their files look, and meet the delta in all
    shuffle partitions: keys pack so well that joining partitions by size fills a task's memory.
    A delta key that occurs twice stops the job. ``with_action`` adds a column of unchanged,
    update, insert or delete, and keeps deleted rows.
    """
    changes = _unique_delta(delta, keys) if check_unique else delta
    rest = [c for c in target.columns if c not in keys]
    renamed = changes.select(
        *[column(k).alias(f"_d_{k}") for k in keys],
        column(op).alias("_op"),
        *[column(c).alias(f"_d_{c}") for c in rest if c in changes.columns],
        F.lit(True).alias("_hit"),
    )
    condition = [column(k) == column(f"_d_{k}") for k in keys]
    joined = target.join(renamed, condition, "left")
    is_delete = F.col("_op").eqNullSafe(F.lit(DELETE))
    action = F.when(F.col("_hit").isNull(), "unchanged").when(is_delete, "delete").otherwise("update")
    updated = [
        F.when(F.col("_hit"), column(f"_d_{c}")).otherwise(column(c)).alias(c) if c in changes.columns else column(c)
        for c in rest
    ]
    kept = joined.select(*[column(k) for k in keys], *updated, action.alias("action"))
    if not with_action:
        kept = kept.where(F.col("action") != "delete")
    known = target.select(*keys).distinct().withColumn("_known", F.lit(True)).hint("merge")
    asked = changes.where(~column(op).eqNullSafe(F.lit(DELETE)))
    # a number given outright keeps the partitions apart, and an outer join stays above them
    parts = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fresh = asked.repartition(parts, *[column(k) for k in keys]).join(known, list(keys), "left").where("_known is null")
    inserted = fresh.select(
        *[column(k) for k in keys],
        *[column(c) if c in changes.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in rest],
        F.lit("insert").alias("action"),
    )
    merged = kept.unionByName(inserted)
    columns = target.columns + (["action"] if with_action else [])
    return merged.select(*columns)


def append_all(target: DataFrame, delta: DataFrame) -> DataFrame:
    """The naive load: every delta row is added. Not idempotent."""
    return target.unionByName(delta.select(*target.columns))


def merge_actions(merged: DataFrame) -> DataFrame:
    """Row count per action of an ``apply_merge(..., with_action=True)`` result."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest change of each key, ready for ``apply_merge``."""
    return latest_per_key(changes, keys, order)


def merge_idempotency(
    name: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    target: DataFrame,
    delta: DataFrame,
    columns: Sequence[str],
) -> DataFrame:
    """Applying a merge twice gives the table that applying it once gave."""
    once = durable(merge(target, delta))
    twice = merge(once, delta)
    wide = side_by_side(
        digest.exact_fingerprint(once, columns), digest.exact_fingerprint(twice, columns), ["row_count", "digest"]
    )
    return to_checks(
        wide,
        "merge_idempotency",
        name,
        F.col("s_digest") == F.col("t_digest"),
        F.format_string("rows after first=%s second=%s", "s_row_count", "t_row_count"),
        F.col("s_digest"),
        F.col("t_digest"),
    )


def surviving_deletes(target: DataFrame, delta: DataFrame, keys: Sequence[str], op: str = "op") -> DataFrame:
    """Target keys the delta asked to delete."""
    deleted = delta.where(column(op) == DELETE).select(*keys).distinct()
    return target.join(deleted, list(keys), "left_semi").select(*keys)


def deletes_applied(
    name: str, target: DataFrame, delta: DataFrame, keys: Sequence[str], op: str = "op"
) -> DataFrame:
    left = surviving_deletes(target, delta, keys, op).agg(F.count(F.lit(1)).alias("n"))
    return to_checks(
        left,
        "merge_idempotency",
        f"{name} (deletes)",
        F.col("n") == 0,
        F.concat(F.col("n").cast("string"), F.lit(" deleted keys still present")),
        "0",
        F.col("n"),
    )
