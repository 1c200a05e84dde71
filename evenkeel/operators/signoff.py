"""Sign-off over all checks: which patterns are proven, and what a flow still lacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.checks import overall_status

# The registered patterns, and those each flow group needs.
PATTERNS = (
    "schema_conformance",
    "rowcount_parity",
    "aggregate_parity",
    "fingerprint_parity",
    "query_parity",
    "bulk_load",
    "epoch_conversion",
    "decimal_roundtrip",
    "scd2_continuity",
    "merge_idempotency",
    "fk_orphan",
    "egress_parity",
    "query_performance",
    "transform_unit",
    "transform_diff",
)
FLOW_GROUPS = {
    "Target Schema": ("epoch_conversion", "schema_conformance"),
    "Extract-Load": ("bulk_load", "decimal_roundtrip"),
    "Transform": (
        "aggregate_parity",
        "epoch_conversion",
        "fingerprint_parity",
        "fk_orphan",
        "merge_idempotency",
        "rowcount_parity",
        "scd2_continuity",
    ),
    "Consumer Migration": ("query_parity",),
    "Egress": ("egress_parity",),
    "Historical Backfill": (
        "aggregate_parity",
        "epoch_conversion",
        "fingerprint_parity",
        "fk_orphan",
        "rowcount_parity",
        "scd2_continuity",
    ),
}


def pattern_coverage(checks: DataFrame) -> DataFrame:
    """(pattern, status, checks, covered): covered means at least one PASS."""
    passed = checks.groupBy("pattern").agg(F.bool_or(F.col("status") == "PASS").alias("covered"))
    return overall_status(checks, ["pattern"]).join(passed, "pattern")


def missing_patterns(checks: DataFrame, required: Sequence[str] = PATTERNS) -> DataFrame:
    """Required patterns without a passing check."""
    wanted = checks.sparkSession.createDataFrame([(p,) for p in required], "pattern string")
    covered = checks.where(F.col("status") == "PASS").select("pattern").distinct()
    return wanted.join(covered, "pattern", "left_anti")


def flow_gaps(checks: DataFrame, groups: Mapping[str, Sequence[str]] = FLOW_GROUPS) -> DataFrame:
    """(flow_group, pattern) a flow group requires and no passing check covers."""
    rows = [(g, p) for g, patterns in groups.items() for p in patterns]
    wanted = checks.sparkSession.createDataFrame(rows, "flow_group string, pattern string")
    covered = checks.where(F.col("status") == "PASS").select("pattern").distinct()
    return wanted.join(covered, "pattern", "left_anti").select("flow_group", "pattern")
