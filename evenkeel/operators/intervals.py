"""Rows of the same key that start within a time span after another row's end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.operators.ordered import ROWS_PER_CHUNK, find_cuts, with_running_sum


def followers_within(
    df: DataFrame,
    row_id: str,
    key: str,
    start: str,
    end: str,
    days: int,
    keep: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(row_id, keep..., followers): how many rows of the key start in (end, end + days].

    The pairs are counted, never built: with C(t) the rows of the key that started by t, the
    answer is C(end + days) - C(end). Both come from one running sum over starts and probes,
    so the work is linear even where one key holds much of the table. Equal rows are counted once and written out
    again, and rows that share only their id stay apart by key and end.
    """
    rows = df.select(row_id, key, *keep, column(start).alias("_start"), column(end).alias("_end"))
    matchable = column(key).isNotNull()
    probe = matchable & F.col("_end").isNotNull()
    kept = [row_id, *keep]
    empty = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in kept]
    begun = rows.where(matchable & F.col("_start").isNotNull()).groupBy(key, "_start").agg(F.count(F.lit(1)).alias("_add"))
    starts = begun.select(
        key, *empty, F.col("_start").alias("_at"), F.lit(0).alias("_kind"), "_add", F.lit(0).alias("_sign"),
        F.lit(None).cast(rows.schema["_end"].dataType).alias("_end"), F.lit(0).cast("bigint").alias("_copies"),
    )
    until = F.expr(f"_end + INTERVAL {int(days)} DAYS")
    kept_rows = rows.where(probe).groupBy(key, *kept, "_end").agg(F.count(F.lit(1)).alias("_copies"))
    ends = kept_rows.select(
        key,
        *kept,
        "_end",
        "_copies",
        F.explode(F.array(F.struct(F.col("_end").alias("at"), F.lit(-1).alias("sign")),
                          F.struct(until.alias("at"), F.lit(1).alias("sign")))).alias("_probe"),
    ).select(
        key, *kept, F.col("_probe.at").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("bigint").alias("_add"),
        F.col("_probe.sign").alias("_sign"), "_end", "_copies",
    )
    points = starts.unionByName(ends)
    # starts of one instant are one row and probes part by their row, so that no instant fills a chunk
    order = ["_at", "_kind", row_id]
    cuts = find_cuts(points, [key], order, rows_per_chunk)
    running = with_running_sum(points, [key], order, "_add", "_upto", cuts)
    each = list(dict.fromkeys([*kept, key]))
    counted = running.where(F.col("_kind") == 1).groupBy(*each, "_end", "_copies").agg(
        F.sum(F.col("_sign") * F.col("_upto")).alias("followers")
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    counted = counted.select(*kept, "followers", copies.alias("_copy")).drop("_copy")
    unmatched = rows.where(~probe).select(*kept, F.lit(0).cast("bigint").alias("followers"))
    return counted.unionByName(unmatched)
