"""Row numbers, NTILE and PERCENT_RANK over a whole frame, without a one-task window.

The frame is range-partitioned and sorted on the full order, tie-break included, so that
equal leading values spread over partitions too. The position inside a partition is its
running id; the partitions' sizes give the offsets. The numbered frame is checkpointed
because range borders come from a sample and must not be drawn twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.session import durable

PARTITION_SHIFT = 33


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Add the 1-based row number in ``order`` and the total as ``<name>_of``."""
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = durable(in_order.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_id"), PARTITION_SHIFT)
    inside = F.col("_id").bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1))
    placed = placed.select(*[column(c) for c in df.columns], part.alias("_part"), inside.alias("_inside"))
    # one row per partition of the sorted frame, so both these windows and the broadcast are small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")).select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everywhere).alias(f"{name}_of"),
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    rn = F.col("_offset") + F.col("_inside") + 1
    return numbered.select(*[column(c) for c in df.columns], rn.alias(name), f"{name}_of")


def ntile(n: int, row_number: Column, total: Column) -> Column:
    """NTILE(n) from a row number: the first ``total % n`` tiles hold one row more."""
    tiles = F.lit(n)
    small, extra = F.floor(total / tiles), total % tiles
    in_large = row_number <= extra * (small + 1)
    large_tile = F.floor((row_number - 1) / (small + 1)) + 1
    small_tile = extra + F.floor((row_number - 1 - extra * (small + 1)) / F.greatest(small, F.lit(1))) + 1
    return F.when(in_large, large_tile).otherwise(small_tile).cast("int")


def with_percent_rank(df: DataFrame, value: str, row_number: Column, total: Column, name: str) -> DataFrame:
    """Add PERCENT_RANK of ``value`` given the row number in ascending order of that value."""
    numbered = df.withColumn("_rn", row_number).withColumn("_of", total)
    first = numbered.groupBy(column(value).alias("_value")).agg(F.min("_rn").alias("_rank"))
    ranked = numbered.join(first, column(value).eqNullSafe(F.col("_value")))
    share = F.when(F.col("_of") > 1, (F.col("_rank") - 1) / (F.col("_of") - 1)).otherwise(F.lit(0.0))
    return ranked.select(*[column(c) for c in df.columns], share.alias(name))
