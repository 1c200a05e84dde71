"""Query metrics: percentiles over runs, budgets, A/B comparison and drift from a baseline.

Input is a long frame (query_id, side, metric, value) with one row per run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.tolerance import Tolerance, allowed, ratio_holds
from evenkeel.operators.checks import to_checks
from evenkeel.operators.ordered import ROWS_PER_CHUNK, nearest_rank_percentiles

PATTERN = "query_performance"


def summarize_runs(
    runs: DataFrame, by: Sequence[str] = ("query_id", "metric"), rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """p50, p95, min and max per query and metric."""
    return nearest_rank_percentiles(runs, list(by), "value", [50, 95], rows_per_chunk)


def measure(summary: DataFrame) -> DataFrame:
    """Record the percentiles; never gates."""
    return to_checks(
        summary,
        PATTERN,
        F.concat_ws(":", "query_id", "metric"),
        F.lit(True),
        F.format_string("p50=%s p95=%s", F.col("p50").cast("string"), F.col("p95").cast("string")),
        metrics={c: F.col(c) for c in ("runs", "p50", "p95", "min", "max")},
        measurement=True,
    )


def _limits(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def _each_query_and_metric(summary: DataFrame, metrics: Sequence[str]) -> DataFrame:
    asked = F.explode(F.array(*[F.lit(m) for m in metrics]))
    return summary.select("query_id").distinct().select("query_id", asked.alias("metric"))


def assert_budgets(summary: DataFrame, budgets: Mapping[tuple[str, str], float]) -> DataFrame:
    """p95 of (query_id, metric) within its budget; a metric that was not measured fails."""
    wanted = _limits(
        summary, [(q, m, float(v)) for (q, m), v in budgets.items()], "query_id string, metric string, budget double"
    )
    joined = wanted.join(summary.select("query_id", "metric", "p95"), ["query_id", "metric"], "left")
    message = F.when(F.col("p95").isNull(), "metric unavailable").otherwise(
        F.concat_ws(" ", F.lit("p95"), F.col("p95").cast("string"), F.lit("budget"), F.col("budget").cast("string"))
    )
    return to_checks(
        joined,
        PATTERN,
        F.concat_ws(":", "query_id", "metric"),
        F.col("p95") <= F.col("budget"),
        message,
        F.col("budget"),
        F.col("p95"),
    )


def compare_sides(
    summary: DataFrame, conditions: Mapping[str, tuple[str, float] | None], a: str = "a", b: str = "b"
) -> DataFrame:
    """Metric of side ``b`` against side ``a`` per query: {metric: (operator, factor)}; None only reports.

    ``summary`` is per (query_id, side, metric). A metric either side lacks fails.
    """
    wide = summary.groupBy("query_id", "metric").agg(
        F.max(F.when(F.col("side") == a, F.col("p95"))).cast("double").alias("a"),
        F.max(F.when(F.col("side") == b, F.col("p95"))).cast("double").alias("b"),
    )
    every = _each_query_and_metric(summary, list(conditions))
    joined = every.join(wide, ["query_id", "metric"], "left")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    passed, reported = F.lit(False), F.lit(False)
    for metric, condition in conditions.items():
        this = F.col("metric") == metric
        verdict = F.lit(True) if condition is None else ratio_holds(F.col("a"), F.col("b"), *condition)
        passed = F.when(this, verdict).otherwise(passed)
        reported = F.when(this, F.lit(condition is None)).otherwise(reported)
    ratio = F.when(F.col("a") == 0, F.lit(float("inf"))).otherwise(F.try_divide("b", "a"))
    message = F.when(both, F.concat(F.lit("b/a="), F.format_string("%.2f", ratio))).otherwise("metric unavailable")
    return to_checks(
        joined,
        PATTERN,
        F.concat_ws(":", "query_id", "metric"),
        both & passed,
        message,
        F.col("a"),
        F.col("b"),
        measurement=both & reported,
    )


def regression(
    summary: DataFrame, baseline: DataFrame, tolerances: Mapping[str, Tolerance]
) -> tuple[DataFrame, DataFrame]:
    """Checks against a stored baseline (query_id, metric, value), and the baseline to store next.

    A query without any baseline passes and enters it; one whose metric is missing on either
    side fails; growth beyond the tolerance fails, shrinking never does.
    """
    current = summary.select("query_id", "metric", F.col("p95").cast("double").alias("current"))
    known = baseline.select("query_id").distinct().withColumn("_known", F.lit(True))
    every = _each_query_and_metric(summary, list(tolerances)).join(known, "query_id", "left")
    joined = every.join(current, ["query_id", "metric"], "left").join(
        baseline.select("query_id", "metric", F.col("value").cast("double").alias("base")), ["query_id", "metric"], "left"
    )
    limit = F.lit(None).cast("double")
    for metric, tolerance in tolerances.items():
        limit = F.when(
            F.col("metric") == metric, F.col("base") + allowed(tolerance, F.col("base"))
        ).otherwise(limit)
    first = F.col("_known").isNull()
    passed: Column = first | F.coalesce(F.col("current") <= limit, F.lit(False))
    message = (
        F.when(first, "baseline established")
        .when(F.col("current").isNull() | F.col("base").isNull(), "metric unavailable")
        .otherwise(F.concat_ws(" ", F.lit("current"), F.col("current").cast("string"), F.lit("allowed"), limit.cast("string")))
    )
    checks = to_checks(
        joined,
        PATTERN,
        F.concat_ws(":", "query_id", "metric"),
        passed,
        message,
        F.col("base"),
        F.col("current"),
        measurement=first,
    )
    fresh = joined.where(first & F.col("current").isNotNull()).select(
        "query_id", "metric", F.col("current").alias("value")
    )
    stored = baseline.select("query_id", "metric", F.col("value").cast("double").alias("value"))
    return checks, stored.unionByName(fresh)
