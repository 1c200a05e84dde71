"""Child keys without a parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.operators.checks import side_by_side, to_checks, union_all


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent; a NULL key has none."""
    known = parent.select(column(parent_key).alias("_parent")).distinct()
    return child.join(known, column(child_key) == F.col("_parent"), "left_anti")


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row (children, orphans). Children are counted per key first, so hot keys stay small."""
    per_key = child.groupBy(column(child_key).alias("_child")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(column(parent_key).alias("_parent")).distinct()
    joined = per_key.join(known, F.col("_child") == F.col("_parent"), "left")
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum("_n"), zero).alias("children"),
        F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("_n"))), zero).alias("orphans"),
    )


def _rate(prefix: str) -> Column:
    share = F.try_divide(F.col(f"{prefix}orphans").cast("double"), F.col(f"{prefix}children").cast("double"))
    return F.coalesce(share, F.lit(0.0))


def fk_orphans(
    name: str,
    source_counts: DataFrame | None,
    target_counts: DataFrame,
    tolerance_pp: float = 0.0,
    max_orphan_rate: float | None = None,
) -> DataFrame:
    """Orphan rate against the source's, in percentage points, and against a cap in percent."""
    found = []
    if source_counts is not None:
        wide = side_by_side(source_counts, target_counts, ["children", "orphans"])
        found.append(
            to_checks(
                wide,
                "fk_orphan",
                name,
                F.abs(_rate("t_") - _rate("s_")) <= F.lit(tolerance_pp / 100),
                F.format_string("orphans source=%s target=%s", "s_orphans", "t_orphans"),
                _rate("s_"),
                _rate("t_"),
                {"source_orphans": F.col("s_orphans"), "target_orphans": F.col("t_orphans")},
            )
        )
    if max_orphan_rate is not None:
        found.append(
            to_checks(
                target_counts,
                "fk_orphan",
                f"{name} (cap)",
                _rate("") <= F.lit(max_orphan_rate / 100),
                F.format_string("orphans=%s of %s", "orphans", "children"),
                F.lit(max_orphan_rate / 100),
                _rate(""),
            )
        )
    return union_all(found)
