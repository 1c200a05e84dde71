"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the folder, BENCH_CPUS the local cores, BENCH_QUERIES an optional
comma-separated choice, BENCH_RUNS how often each query runs after one run to warm up; its time is the median. Results are drained without being collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "rowcount_parity aggregate_parity fingerprint_digest fingerprint_buckets fingerprint_canonical fingerprint_parity "
    "localize_keys localize_duplicate_keys multiset_diff row_diff query_parity_rowset query_parity_scalar "
    "transform_diff property_asserts epoch_conversion decimal_roundtrip scd2_build scd2_continuity scd2_checks row_hash "
    "merge_apply merge_actions merge_idempotent change_log_merge fk_orphan conformance_profile conform "
    "metrics_percentiles metrics_compare metrics_regression range_self_join latest_per_user org_hierarchy active_agents "
    "csat_rollup call_drivers repeat_contacts billing_reconciliation agent_roster agent_scorecard attrition_risk "
    "queue_sla_attainment first_contact_resolution occupancy shrinkage program_margin client_summary"
).split()


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evenkeel-bench")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    from evenkeel.plans.suites import QUERIES

    times = {}
    for name in chosen:
        took = []
        for _ in range(1 + runs):  # the first one only warms up
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - started)
            if sum(took) > 8:
                break
        times[name] = round(statistics.median(took[1:] or took), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
