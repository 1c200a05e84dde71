"""The checks frame: one row per verdict, the common output of all validations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "pattern string, suite_id string, target string, status string, message string, "
    "expected string, actual string, metrics map<string,string>, measurement boolean, "
    "story_id string, criteria_index int"
)


def _text(value: Column | str | None) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value).cast("string")


def to_checks(
    df: DataFrame,
    pattern: str,
    target: Column | str,
    passed: Column,
    message: Column | str = "",
    expected: Column | str | None = None,
    actual: Column | str | None = None,
    metrics: dict[str, Column] | None = None,
    measurement: Column | bool = False,
    suite_id: str | None = None,
    story_id: str | None = None,
    criteria_index: int | None = None,
) -> DataFrame:
    """Turn every row of ``df`` into a check; ``passed`` NULL counts as a failure."""
    pairs = [part for name, value in (metrics or {}).items() for part in (F.lit(name), _text(value))]
    metric_map = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(
        F.lit(pattern).alias("pattern"),
        F.lit(suite_id or pattern).alias("suite_id"),
        _text(target).alias("target"),
        F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        _text(message).alias("message"),
        _text(expected).alias("expected"),
        _text(actual).alias("actual"),
        metric_map.alias("metrics"),
        (measurement if isinstance(measurement, Column) else F.lit(measurement)).alias("measurement"),
        _text(story_id).alias("story_id"),
        F.lit(criteria_index).cast("int").alias("criteria_index"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def error_check(spark: SparkSession, pattern: str, target: str, message: str) -> DataFrame:
    """A check that could not be evaluated."""
    row = (pattern, pattern, target, "ERROR", message, None, None, {}, False, None, None)
    return spark.createDataFrame([row], SCHEMA)


def side_by_side(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """Two frames of at most one row each as one row of ``s_`` and ``t_`` columns; no join needed."""
    tagged = source.select(F.lit(True).alias("is_source"), *columns).unionByName(
        target.select(F.lit(False).alias("is_source"), *columns)
    )
    picked = []
    for c in columns:
        picked.append(F.max(F.when(F.col("is_source"), F.col(c))).alias(f"s_{c}"))
        picked.append(F.max(F.when(~F.col("is_source"), F.col(c))).alias(f"t_{c}"))
    return tagged.agg(*picked)


def overall_status(checks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """ERROR beats FAIL beats PASS; measurements never gate and no checks at all is ERROR."""
    severity = F.when(F.col("status") == "ERROR", 2).when(F.col("status") == "FAIL", 1).otherwise(0)
    gating = F.when(~F.col("measurement") | (F.col("status") == "ERROR"), severity).otherwise(0)
    worst = F.coalesce(F.max(gating), F.lit(2))
    status = F.when(worst == 2, "ERROR").when(worst == 1, "FAIL").otherwise("PASS")
    return checks.groupBy(*(by or [])).agg(status.alias("status"), F.count(F.lit(1)).alias("checks"))


def failures(checks: DataFrame) -> DataFrame:
    """Rows of a checks frame that call for attention."""
    return checks.where(F.col("status").isin("FAIL", "ERROR"))


def export_rows(checks: DataFrame) -> DataFrame:
    """One flat row per criterion, for a results table or JSON files."""
    return checks.select(
        "story_id",
        "criteria_index",
        "pattern",
        "target",
        F.lower("status").alias("status"),
        F.col("message").alias("detail"),
    )
