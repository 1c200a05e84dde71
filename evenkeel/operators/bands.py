"""Pairs of rows with equal keys where an instant of one lies in a window of the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.operators.ordered import ROWS_PER_CHUNK
from evenkeel.session import durable


def band_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    after: str,
    until: str,
    point: str,
    width_seconds: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(left, right): structs of the rows with equal ``keys`` and ``after`` < ``point`` <= ``until``.

    Time is cut into bins of ``width_seconds``, best the usual length of a window: a window then meets two bins, and
    the rows of a key meet only near each other in time. A (key, bin) with more than ``rows_per_chunk`` instants is
    dealt to several tasks by a hash of its rows, which its windows visit one by one; one aggregation finds out which.
    NULL keys and instants match nothing, repeated rows each make their pairs, and the columns of both sides may have
    the same names.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    on = [*names, "_bin"]
    bin_of = lambda c: F.floor(F.unix_seconds(column(c).cast("timestamp")) / width_seconds)
    side = lambda df, name: [*[column(k).alias(n) for k, n in zip(keys, names)], F.struct(*map(column, df.columns)).alias(name)]
    windows = left.where(column(after) < column(until)).select(*side(left, "left"), column(after).alias("_after"), column(until).alias("_until"))
    windows = windows.select("*", F.explode(F.sequence(bin_of("_after"), bin_of("_until"))).alias("_bin"))
    points = right.where(column(point).isNotNull()).select(*side(right, "right"), column(point).alias("_point"), bin_of(point).alias("_bin"))
    hot = points.groupBy(*on).agg(F.ceil(F.count("*") / rows_per_chunk).alias("_parts")).where("_parts > 1")
    hot = durable(hot)
    if not hot.isEmpty():
        # fewer rows than the points have chunks
        parts = F.coalesce("_parts", F.lit(1))
        spread = F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1))
        windows = windows.join(hot, on, "left").select("*", spread.alias("_part")).drop("_parts")
        points = points.join(hot, on, "left").select("*", F.pmod(F.xxhash64("right"), parts.cast("bigint")).alias("_part")).drop("_parts")
        on = [*on, "_part"]
    met = windows.join(points, on)
    return met.where((F.col("_point") > F.col("_after")) & (F.col("_point") <= F.col("_until"))).select("left", "right")
