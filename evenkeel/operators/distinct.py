"""Stored distinct counts: one sketch per group, merged upwards without reading the rows again.

A theta sketch holds at most 2^``size`` hashes whatever it has seen. Up to that many different values its estimate is
exact; beyond, the relative standard error is about 2^(-size/2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column

#: 2^14 hashes, 128 kB for a full sketch: an error of 0.8 % beyond 16,384 values.
SKETCH_SIZE = 14


def sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """The keys and ``sketch`` of the values in each group; NULL values count for nothing, NULL keys are a group.

    Partial sketches are made in the tasks, so a hot group moves one sketch a task.
    """
    return df.groupBy(*[column(k) for k in keys]).agg(F.theta_sketch_agg(column(value), size).alias("sketch"))


def merged(stored: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of fewer keys: what several groups hold between them, each value once."""
    return stored.groupBy(*[column(k) for k in keys]).agg(F.theta_union_agg("sketch", size).alias("sketch"))


def estimates(stored: DataFrame, name: str = "n_distinct") -> DataFrame:
    """The sketch column replaced by its count."""
    return stored.withColumn(name, F.theta_sketch_estimate("sketch").cast("long")).drop("sketch")
