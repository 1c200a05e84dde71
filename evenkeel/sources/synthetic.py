"""Generated tables of any size: an id and columns derived from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Row counts of the named tiers.
TIERS = {"small": 1_000_000, "medium": 100_000_000, "large": 1_000_000_000}


def synthetic_table(
    spark: SparkSession, rows: int | str, columns: Mapping[str, tuple[str, str] | str] | None = None
) -> DataFrame:
    """``id`` 1..rows plus columns from SQL expressions over it, optionally cast.

    ``columns`` maps a name to an expression, or to (expression, type). Write ``rand(seed)``
    with a seed: a task that runs again must draw the same values.
    """
    n = TIERS[rows] if isinstance(rows, str) else rows
    out: list[Column] = [F.col("id")]
    for name, spec in (columns or {}).items():
        expression, dtype = (spec, None) if isinstance(spec, str) else spec
        value = F.expr(expression)
        out.append((value.cast(dtype) if dtype else value).alias(name))
    return spark.range(1, n + 1).select(*out)
