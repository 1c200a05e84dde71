"""Every operator bound to whole tables: name -> (spark, folder) -> DataFrame.

``portable`` prints dates and instants and widens decimals, so that results compare across
engines by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import digest
from evenkeel.functions.canon import column
from evenkeel.functions.masking import mask
from evenkeel.operators import (
    asserts,
    checks,
    conformance,
    dimension,
    distinct,
    encoding,
    foreign_keys,
    hierarchy,
    localize,
    merge,
    metrics,
    parity,
    signoff,
    sketch,
)
from evenkeel.operators.bands import band_join
from evenkeel.operators.intervals import followers_within
from evenkeel.operators.ordered import latest_per_key
from evenkeel.plans import marts, staging
from evenkeel.plans.warehouse import source
from evenkeel.session import durable, fresh_path
from evenkeel.sources import intake, readers, writers
from evenkeel.sources.versioned import VersionedTable
from evenkeel.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_returnflag", "l_shipdate"]
#: Stands for a secret that a caller keeps elsewhere.
MASK_KEY = "example"
EPOCH_RULE = encoding.EpochRule("millis", expect_years=(2020, 2030))
TIMELINE = dimension.Timeline(
    "user_id", "eff_from", "eff_to", "is_current", row_hash="row_hash", hash_columns=("user_id", "event_type")
)


def portable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        col = column(f.name)
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, T.IntegralType):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def verdicts(found: DataFrame) -> DataFrame:
    return found.select("target", "status", "expected", "actual")


def statuses(found: DataFrame) -> DataFrame:
    return found.select("target", "status")


QUERIES: dict[str, Query] = {}


def query(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a function whose parameters name the tables it reads."""
    names = function.__code__.co_varnames[: function.__code__.co_argcount]

    def bound(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(*[spark if n == "spark" else source(spark, folder, n) for n in names]))

    QUERIES[function.__name__] = bound
    return function


# parity of counts, aggregates, fingerprints and queries


@query
def rowcount_parity(orders, orders_target, lineitem, lineitem_target):
    pairs = [
        parity.TablePair("orders", orders, orders_target, "0.1%"),
        parity.TablePair("orders_exact", orders, orders_target),
        parity.TablePair("orders_urgent", orders, orders_target, 5, "o_orderpriority = '1-URGENT'",
                         "o_orderpriority = '1-URGENT'"),
        parity.TablePair("lineitem", lineitem, lineitem_target, "0.01%"),
    ]
    return verdicts(parity.rowcount_parity(pairs))


@query
def aggregate_parity(money_source, money_target):
    aggregates = [
        parity.Aggregate("price", "sum"),
        parity.Aggregate("price", "max", "0.1%"),
        parity.Aggregate("l_orderkey", "count_distinct"),
        parity.Aggregate("l_returnflag", "count"),
        parity.Aggregate("l_returnflag", "min"),
        parity.Aggregate("l_shipdate", "min"),
        parity.Aggregate("l_shipdate", "max", 1),
    ]
    return verdicts(parity.aggregate_parity("money", money_source, money_target, aggregates))


@query
def fingerprint_digest(orders):
    return digest.fast_fingerprint(orders, ORDER_COLUMNS).withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query
def fingerprint_buckets(orders):
    found = digest.bucket_fingerprints(orders, F.col("o_orderkey"), ORDER_COLUMNS)
    return found.withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query
def fingerprint_canonical(events):
    return digest.exact_fingerprint(events, EVENT_COLUMNS)


@query
def fingerprint_parity(orders, orders_target):
    kept = ["o_custkey", "o_orderstatus", "o_orderdate"]
    return statuses(
        checks.union_all([
            parity.fingerprint_parity("same", orders, orders.repartition("o_custkey"), ORDER_COLUMNS),
            parity.fingerprint_parity("changed", orders, orders_target, ORDER_COLUMNS),
            parity.fast_fingerprint_parity("same_fast", orders, orders.repartition("o_custkey"), ORDER_COLUMNS),
            parity.fast_fingerprint_parity("changed_fast", orders, orders_target, kept),
        ])
    )


@query
def localize_keys(orders, orders_target):
    return localize.differing_keys(orders, orders_target, ["o_orderkey"], ORDER_COLUMNS)


@query
def localize_by_sketch(orders, orders_target):
    return sketch.keys_by_sketch(orders, orders_target, ["o_orderkey"], ORDER_COLUMNS)


@query
def localize_duplicate_keys(lineitem, lineitem_target):
    key = ["l_orderkey", "l_linenumber"]
    return localize.differing_keys(lineitem, lineitem_target, key, LINE_COLUMNS, buckets=None)


@query
def localize_summary(orders, orders_target):
    found = localize.differing_keys(orders, orders_target, ["o_orderkey"], ORDER_COLUMNS)
    return localize.difference_summary(found)


@query
def localize_sample(orders, orders_target):
    found = localize.differing_keys(orders, orders_target, ["o_orderkey"], ORDER_COLUMNS)
    return localize.key_sample(found, ["o_orderkey"], 10)


@query
def multiset_diff(orders, orders_target):
    columns = ["o_custkey", "o_orderstatus", "o_totalprice"]
    return localize.multiset_difference(orders, orders_target, columns, buckets=256).withColumn(
        "row", F.replace("row", F.lit("\x1f"), F.lit("|"))
    )


@query
def row_diff(lineitem, lineitem_target):
    return localize.row_difference(lineitem, lineitem_target, ["l_returnflag", "l_linenumber", "l_quantity"])


@query
def query_parity_rowset(events, elt_staging):
    by_type = events.groupBy(F.col("event_type").alias("channel")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("amount")
    )
    again = elt_staging.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    filtered = elt_staging.where("status = 'raw'").groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
    return verdicts(
        checks.union_all([
            parity.rowset_parity("channel_rollup", by_type, again),
            parity.rowset_parity("channel_rollup_filtered", by_type, filtered),
        ])
    ).select("target", "status")


@query
def query_parity_scalar(fact_interaction):
    exact = fact_interaction.agg(F.count_distinct("customer_ref").alias("n"))
    approximate = fact_interaction.agg(F.approx_count_distinct("customer_ref", 0.01).alias("n"))
    fewer = fact_interaction.where("resolved_flag").agg(F.count(F.lit(1)).alias("n"))
    every = fact_interaction.agg(F.count(F.lit(1)).alias("n"))
    return statuses(
        checks.union_all([
            parity.scalar_parity("approx_distinct_contacts", exact, approximate, "5%"),
            parity.scalar_parity("resolved_only", every, fewer, "5%"),
        ])
    )


# transforms


@query
def transform_diff(raw_invoices):
    legacy = "SELECT op, count(*) AS n, sum(amount) AS amount FROM {raw} GROUP BY op"
    same = "SELECT sum(amount) AS AMOUNT, count(*) AS N, op FROM {raw} GROUP BY op"
    drops = "SELECT op, count(*) AS n, sum(amount) AS amount FROM {raw} WHERE op <> 'D' GROUP BY op"
    extra = "SELECT op, count(*) AS n, sum(amount) AS amount, max(amount) AS top FROM {raw} GROUP BY op"
    given = {"raw": raw_invoices}
    return statuses(
        checks.union_all([
            asserts.transform_diff("same", legacy, same, given),
            asserts.transform_diff("drops_deletes", legacy, drops, given),
            asserts.transform_diff("extra_column", legacy, extra, given),
        ])
    )


@query
def transform_unit(elt_staging):
    wanted = elt_staging.where("status <> 'void'").select(
        "id", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_ts"), F.col("amount").cast("string")
    )
    given = {"staging": elt_staging}
    bad = "SELECT id, CASE WHEN id = 1 THEN 99.99 ELSE amount END AS amount, event_ts FROM {staging} WHERE status = 'raw'"
    found = checks.union_all([
        asserts.transform_unit("mart", lambda staging: raw_to_mart_of(staging), given, wanted),
        asserts.transform_unit("mart_bad", bad, given, wanted),
    ])
    return found.select("target", "status", F.col("metrics")["missing"].alias("missing"), F.col("metrics")["extra"].alias("extra"))


def raw_to_mart_of(staged: DataFrame) -> DataFrame:
    return staging.raw_to_mart(staged)


@query
def property_asserts(lineitem, orders, raw_events):
    found = checks.union_all([
        asserts.property_asserts("lineitem", lineitem, unique=[["l_orderkey", "l_linenumber"]], no_nulls=["l_tax"]),
        asserts.property_asserts("orders", orders, unique=[["o_orderkey"]], no_nulls=["o_orderdate"]),
        asserts.property_asserts("raw_events", raw_events, rowcount=-1, no_nulls=["event_type", "day_text"]),
    ])
    return verdicts(found)


@query
def raw_to_mart(elt_staging):
    return staging.raw_to_mart(elt_staging)


@query
def invoices_from_raw(raw_invoices):
    return staging.invoices_from_raw(raw_invoices, upper_case_op=True)


# encodings


@query
def epoch_conversion(epoch_source, epoch_target):
    found = encoding.classify_epochs(epoch_source, epoch_target, ["event_id"], "raw", "converted_ts", EPOCH_RULE)
    return found.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query
def epoch_failures(epoch_source, epoch_target):
    found = encoding.classify_epochs(epoch_source, epoch_target, ["event_id"], "raw", "converted_ts", EPOCH_RULE)
    return found.where(~F.col("class").isin(*encoding.GOOD_CLASSES)).select("event_id", "raw", "expected", "actual", "class")


@query
def epoch_checks(epoch_source, epoch_target, epoch_audit):
    found = encoding.classify_epochs(epoch_source, epoch_target, ["event_id"], "raw", "converted_ts", EPOCH_RULE)
    return verdicts(encoding.epoch_conversion("events.converted_ts", found, True, epoch_audit, "src_table = 'epoch_source'"))


@query
def decimal_roundtrip(balance_source, balance_target):
    found = encoding.decimal_differences(balance_source, balance_target, ["c_custkey"], ["balance", "balance_text"])
    return found.select("c_custkey", "column", "reason")


@query
def decimal_checks(balance_source, balance_target):
    columns = ["balance", "balance_text"]
    found = encoding.decimal_differences(balance_source, balance_target, ["c_custkey"], columns)
    return verdicts(encoding.decimal_roundtrip("customer", found, columns))


# dimensions


def user_versions(user_changes: DataFrame) -> DataFrame:
    return dimension.build_versions(user_changes, "user_id", "changed_at", ["event_type"], ["event_id"])


@query
def scd2_build(user_changes):
    return user_versions(user_changes)


def broken_versions(user_changes: DataFrame) -> DataFrame:
    """Versions with planted gaps, flags and hashes."""
    odd = F.dayofmonth("eff_from") % 13 == 0
    v = user_versions(user_changes)
    return v.select(
        "user_id",
        "event_type",
        "eff_from",
        F.when(odd & ~F.col("is_current"), F.col("eff_to") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("eff_to")).alias("eff_to"),
        F.when(F.col("user_id") % 29 == 0, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        F.when(F.hour("eff_from") == 5, F.lit("0")).otherwise(F.col("row_hash")).alias("row_hash"),
    )


@query
def scd2_continuity(user_changes):
    return dimension.timeline_violations(broken_versions(user_changes), TIMELINE).groupBy("rule", "entity").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def scd2_checks(user_changes):
    return verdicts(
        checks.union_all([
            dimension.scd2_continuity("good", user_versions(user_changes), TIMELINE),
            dimension.scd2_continuity("broken", broken_versions(user_changes), TIMELINE),
        ])
    )


@query
def row_hash(customer_hashed):
    found = dimension.row_hash_mismatches(customer_hashed, "row_hash", ["c_custkey", "c_name", "c_mktsegment"])
    return found.select("c_custkey", "row_hash", "computed_hash")


# merges


@query
def merge_apply(orders, order_delta):
    return merge.apply_merge(orders, order_delta, ["o_orderkey"])


def _patched(orders: DataFrame, order_patch: DataFrame) -> VersionedTable:
    table = VersionedTable(orders.sparkSession, fresh_path(orders.sparkSession, "orders"), ("o_orderkey",), rows_per_file=1_000)
    table.overwrite(orders, "load")
    table.merge(order_patch, run_id="patch")
    return table


@query
def versioned_merge(orders, order_patch):
    return _patched(orders, order_patch).read()


@query
def versioned_history(orders, order_patch):
    runs = _patched(orders, order_patch).history()
    return runs.select("version", "run_id", "action", "n_rows", (F.col("kept_files") > 0).alias("kept_some"))


@query
def merge_actions(orders, order_delta):
    return merge.merge_actions(merge.apply_merge(orders, order_delta, ["o_orderkey"], with_action=True))


@query
def merge_idempotent(orders, order_delta):
    return statuses(
        checks.union_all([
            merge.merge_idempotency(
                "merge", lambda t, d: merge.apply_merge(t, d, ["o_orderkey"]), orders, order_delta, ORDER_COLUMNS
            ),
            merge.merge_idempotency("append", merge.append_all, orders, order_delta, ORDER_COLUMNS),
        ])
    )


@query
def deletes_absent(orders, order_delta):
    merged = merge.apply_merge(orders, order_delta, ["o_orderkey"])
    return verdicts(
        checks.union_all([
            merge.deletes_applied("merged", merged, order_delta, ["o_orderkey"]),
            merge.deletes_applied("unmerged", orders, order_delta, ["o_orderkey"]),
        ])
    )


@query
def change_log_merge(user_state, user_changes):
    return staging.apply_change_log(user_state, user_changes, ["user_id"], "changed_at")


# foreign keys


@query
def fk_orphan(orders, customer, customer_kept):
    source_counts = foreign_keys.orphan_counts(orders, "o_custkey", customer, "c_custkey")
    target_counts = foreign_keys.orphan_counts(orders, "o_custkey", customer_kept, "c_custkey")
    found = checks.union_all([
        foreign_keys.fk_orphans("same", source_counts, source_counts, 0.0),
        foreign_keys.fk_orphans("orders.o_custkey", source_counts, target_counts, 0.5, 5.0),
    ])
    return found.select("target", "status")


@query
def fk_orphan_counts(orders, customer_kept):
    return foreign_keys.orphan_counts(orders, "o_custkey", customer_kept, "c_custkey")


@query
def fk_orphan_rows(orders, customer_kept):
    return foreign_keys.orphans(orders, "o_custkey", customer_kept, "c_custkey").select("o_orderkey", "o_custkey")


# conformance


RAW_EXPECTED = [
    conformance.ExpectedColumn("event_id", "INT64", nullable=False),
    conformance.ExpectedColumn("user_id", "INT64", source_name="user_text", source_type="STRING"),
    conformance.ExpectedColumn("value_text", "NUMERIC(10,1)"),
    conformance.ExpectedColumn("EVENT_TYPE", "STRING", nullable=False),
    conformance.ExpectedColumn("ts_ms", "NUMERIC"),
    conformance.ExpectedColumn("props", "map<string,bigint>"),
]
RAW_MAPPING = [
    conformance.ColumnMapping("event_id", "event_id"),
    conformance.ColumnMapping("user_id", "user_text", "INT64"),
    conformance.ColumnMapping("value", "value_text", "NUMERIC(12,3)"),
    conformance.ColumnMapping("event_type", "event_type"),
    conformance.ColumnMapping("ts", "ts_ms", how="epoch_millis"),
    conformance.ColumnMapping("partition_date", "day_text", how="compact_date"),
    conformance.ColumnMapping("props", "props", "map<string,bigint>", how="json_entries"),
]


@query
def conformance_profile(raw_events):
    return conformance.conformance_profile(raw_events, RAW_EXPECTED)


@query
def conformance_nested(lineitem):
    """Two amounts of each line as an array of structs, with words for the sevenths and no flag for returned lines."""
    flag = F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag")
    number = F.when(F.col("l_linenumber") == 7, F.lit("seven")).otherwise(F.col("l_linenumber").cast("string")).alias("number")
    amounts = [F.struct(number, F.col(c).cast("string").alias("amount"), flag) for c in ("l_extendedprice", "l_discount")]
    rows = lineitem.select(F.array(*amounts, F.when(F.col("l_linenumber") != 3, amounts[0])).alias("amounts"))
    declared = "array<struct<number: bigint not null, amount: decimal(38,1), flag: string not null>>"
    return conformance.nested_profile(rows, [conformance.ExpectedColumn("amounts", declared, nullable=False)])


@query
def conformance_mapping(raw_events):
    return conformance.source_mapping_profile(raw_events, RAW_EXPECTED).select("column", "rule", "bad")


@query
def conform(raw_events):
    good, _ = conformance.conform(raw_events, RAW_MAPPING)
    return good.select("event_id", "user_id", "value", "event_type", "ts", "partition_date",
                       F.col("props")[0]["key"].alias("prop"), F.col("props")[0]["value"].alias("prop_value"))


@query
def conform_quarantine(raw_events):
    _, bad = conformance.conform(raw_events, RAW_MAPPING)
    return bad.select("event_id", "value_text", "day_text", F.array_join("_failed", ",").alias("failed"))


# loads and exports


@query
def bulk_load_check(spark, elt_staging, part):
    lines, rows, columns = (fresh_path(spark, n) for n in ("load-json", "load-csv", "load-orc"))
    writers.export_json(elt_staging, lines, keep_nulls=True)
    part.write.csv(rows, sep="|", header=True)
    part.write.partitionBy("p_brand").orc(columns)
    loads = [
        writers.Load("json", lines, "json", fresh_path(spark, "table"), schema=elt_staging.schema),
        writers.Load("csv", rows, "csv", fresh_path(spark, "table"), delimiter="|", skip_leading_rows=1),
        writers.Load("orc", columns, "orc", fresh_path(spark, "table"), partition_prefix=columns,
                     partition_types="strings", partition_column="p_brand"),
        writers.Load("orc_other", columns, "orc", fresh_path(spark, "table"), expected_count=-1,
                     partition_column="no_such_column"),
        writers.Load("missing", fresh_path(spark, "nothing"), "parquet", fresh_path(spark, "table")),
    ]
    return verdicts(checks.union_all([writers.bulk_load(spark, load) for load in loads]))


@query
def file_intake(spark, events):
    """Folders of files by event_id % 8, most with a planted fault: (part, reason, n_rows landed)."""
    folder = fresh_path(spark, "intake")
    rows = events.select("event_id", "user_id", "event_type", "value", (F.col("event_id") % 8).alias("part"))
    sound, drifted, moved, packed = rows.where("part not in (2, 3, 6)"), *(rows.where(F.col("part") == k) for k in (2, 3, 6))
    for df, compression in (
        (sound, "none"), (drifted.withColumnRenamed("value", "amount"), "none"), (moved.select("user_id", "event_id", "event_type", "value", "part"), "none"), (packed, "gzip")
    ):
        df.write.mode("append").partitionBy("part").option("compression", compression).csv(folder, sep="|", header=True)
    files = intake.examined(spark, folder).where(~F.col("file").startswith("_"))
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("bigint")
    wrong = F.when(part == 4, F.lit("0" * 64)).otherwise(F.col("sha256"))
    promised = durable(files.where(part != 5).select("file", wrong.alias("sha256")))
    promised = promised.unionByName(promised.where(part == 7).withColumn("sha256", F.lit("1" * 64)))
    promised = promised.unionByName(spark.createDataFrame([("part=9/gone.csv", "2" * 64)], "file string, sha256 string"))
    found = durable(intake.judged(files, promised, ["event_id", "user_id", "event_type", "value"], "|"))
    reasons = found.select(part.alias("part"), F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("good"))).otherwise(F.col("reasons"))).alias("reason")).distinct()
    landed = intake.landed(spark, found, "event_id bigint, user_id bigint, event_type string, value double", "|")
    counted = landed.groupBy(F.regexp_extract("_file", "part=([0-9]+)", 1).cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"))
    return reasons.join(counted, "part", "left").select("part", "reason", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("ids", F.lit(0)).alias("ids"))


@query
def egress_roundtrip(spark, elt_staging):
    columns = ["id", "channel", "amount", "event_ts", "status"]
    good, bad = fresh_path(spark, "export"), fresh_path(spark, "export")
    texts = elt_staging.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))
    writers.export_json(texts, good)
    writers.export_json(texts.where("status = 'raw'"), bad)
    schema = "id bigint, channel string, amount string, event_ts string, status string"
    back, short = (readers.read_json_lines(spark, p, schema)[0] for p in (good, bad))
    found = checks.union_all([
        writers.egress_parity("events", elt_staging, back, columns, "amount"),
        writers.egress_parity("events_raw", elt_staging, short, columns, "amount"),
    ])
    return statuses(found)


@query
def control_totals(raw_events):
    return writers.control_totals(raw_events, "value_text")


@query
def exact_totals(digit_amounts):
    return writers.exact_totals(digit_amounts, "amount")


@query
def retained_events(events):
    return writers.retain_partitions(events, "ts", 7, "2024-01-30").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def incremental_rows(events):
    fresh = incremental.new_rows(events, "ts", "2024-01-15 00:00:00")
    mark = incremental.next_watermark(fresh, "events", "ts", "run-2", "2024-02-01 00:00:00", "2024-01-15 00:00:00")
    return mark.select("source_table", F.substring("last_value", 1, 19).alias("last_value"), "last_run_ts", "run_id")


# query metrics


@query
def metrics_percentiles(metric_runs):
    return metrics.summarize_runs(metric_runs)


@query
def metrics_budget(metric_runs):
    budgets = {("click", "value"): 1000.0, ("error", "value"): 50.0, ("view", "elapsed_ms"): 10.0}
    return verdicts(metrics.assert_budgets(metrics.summarize_runs(metric_runs), budgets)).select("target", "status")


@query
def metrics_compare(metric_runs):
    summary = metrics.summarize_runs(metric_runs, ["query_id", "side", "metric"])
    found = metrics.compare_sides(summary, {"value": ("<=", 2.0), "user": ("<", 0.5), "bytes": ("<=", 1.0)})
    return found.select("target", "status", F.col("expected").cast("double").alias("a"), F.col("actual").cast("double").alias("b"))


@query
def metrics_regression(metric_runs, metric_baseline):
    found, _ = metrics.regression(metrics.summarize_runs(metric_runs), metric_baseline, {"value": "10%"})
    return found.select("target", "status", "measurement")


@query
def metrics_baseline_next(metric_runs, metric_baseline):
    _, stored = metrics.regression(metrics.summarize_runs(metric_runs), metric_baseline, {"value": "10%"})
    return stored


# sign-off


def _signoff_checks(orders, orders_target, customer_kept):
    counts = foreign_keys.orphan_counts(orders, "o_custkey", customer_kept, "c_custkey")
    return checks.union_all([
        parity.rowcount_parity([parity.TablePair("orders", orders, orders_target, "1%")]),
        parity.fingerprint_parity("orders", orders, orders_target, ORDER_COLUMNS),
        foreign_keys.fk_orphans("orders", None, counts, max_orphan_rate=1.0),
    ])


@query
def signoff_coverage(orders, orders_target, customer_kept):
    return signoff.pattern_coverage(_signoff_checks(orders, orders_target, customer_kept))


@query
def signoff_gaps(orders, orders_target, customer_kept):
    groups = {"Transform": ("rowcount_parity", "fingerprint_parity", "fk_orphan"), "Egress": ("egress_parity",)}
    return signoff.flow_gaps(_signoff_checks(orders, orders_target, customer_kept), groups)


@query
def check_export(orders, orders_target, customer_kept):
    return checks.export_rows(_signoff_checks(orders, orders_target, customer_kept)).select("pattern", "target", "status")


# staging jobs


@query
def chat_counts(conversations):
    return staging.chat_counts(conversations, "conv_id", "turn", "role")


@query
def ivr_sessions(events):
    return staging.ivr_sessions(events, "user_id", "ts", "event_type", ["purchase"])


@query
def ivr_path(events):
    return staging.ivr_path(events, "user_id", "ts", "event_type", "event_id")


@query
def unite_channels(events, orders):
    mapping = {
        "digital": {"interaction_id": "event_id", "customer": "user_id", "start_ts": "ts"},
        "order": {"interaction_id": "o_orderkey", "customer": "o_custkey", "start_ts": "o_orderdate", "amount": "o_totalprice"},
    }
    united = staging.unite_channels({"digital": events, "order": orders}, mapping)
    return united.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"), F.count("amount").alias("with_amount"), F.count_distinct("customer").alias("customers")
    )


@query
def surrogate_lookup(fact_interaction, dim_agent):
    agents = dim_agent.select(F.col("agent_sk").alias("surrogate"), F.col("agent_sk").alias("agent"), "is_current")
    fact = fact_interaction.select("interaction_id", F.col("agent_sk").alias("agent"))
    return staging.with_surrogate(fact, agents, "agent", "surrogate").groupBy("surrogate").agg(F.count(F.lit(1)).alias("n"))


@query
def period_totals(events):
    measures = [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("amount")]
    return staging.period_totals(events, "ts", "week", ["event_type"], measures, rollup=True)


@query
def hourly_totals(events):
    return staging.period_totals(events, "ts", "hour", [], [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")])


@query
def section_totals(documents):
    lines = F.split("text", "\n")
    scored = documents.select(
        "doc_id",
        F.transform(lines, lambda x: F.struct(F.length(x).alias("points"), (F.length(x) + 10).alias("maximum"))).alias("sections"),
    )
    return staging.section_totals(scored, "sections", "points", "maximum")


# mart queries


@query
def range_self_join(fact_interaction):
    return followers_within(fact_interaction, "interaction_id", "customer_ref", "start_ts", "end_ts", marts.FOLLOW_UP_DAYS)


@query
def follow_up_pairs(fact_interaction):
    days = marts.FOLLOW_UP_DAYS
    windows = fact_interaction.select("interaction_id", "customer_ref", "end_ts", F.expr(f"end_ts + INTERVAL {days} DAYS").alias("until"))
    starts = fact_interaction.select("interaction_id", "customer_ref", "start_ts")
    met = band_join(windows, starts, ["customer_ref"], "end_ts", "until", "start_ts", days * 86400)
    return met.select("left.interaction_id", F.col("right.interaction_id").alias("follower_id"), F.col("right.start_ts").alias("started_at"))


@query
def masked_customers(customer, orders):
    """Customers and their orders, joined on masked keys alone."""
    people = customer.select(
        mask(F.col("c_custkey"), MASK_KEY, "customer").alias("customer_mask"), mask(F.col("c_name"), MASK_KEY, "name").alias("name_mask"),
        "c_mktsegment",
    )
    bought = orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    bought = bought.select(mask(F.col("o_custkey"), MASK_KEY, "customer").alias("customer_mask"), "n_orders")
    return people.join(bought, "customer_mask", "left")


@query
def monthly_users(events):
    """Users a month and event type, from stored sketches a day; exact while a month has no more users than a sketch holds."""
    spark = events.sparkSession
    stored = fresh_path(spark, "sketches")
    days = events.select(F.to_date("ts").alias("day"), "event_type", "user_id")
    distinct.sketches(days, ["day", "event_type"], "user_id").write.parquet(stored)
    by_month = spark.read.parquet(stored).withColumn("month", F.date_format("day", "yyyy-MM"))
    return distinct.estimates(distinct.merged(by_month, ["month", "event_type"]), "n_users")


@query
def latest_per_user(events):
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest_per_key(events, ["user_id"], order).select("user_id", "event_id", "event_type", "value")


@query
def org_hierarchy(ods_org_unit):
    return marts.org_hierarchy(ods_org_unit)


@query
def org_ancestry(org_links):
    return hierarchy.ancestry(org_links, "unit_id", "parent_id")


@query
def active_agents(fact_interaction, dim_agent):
    """The approximate counts themselves differ by engine: report whether they are within 5 %."""
    approximate = marts.active_agents(fact_interaction, dim_agent)
    exact = fact_interaction.join(dim_agent.select("agent_sk", "site_code"), "agent_sk").groupBy("date_key", "site_code").agg(
        F.count_distinct("agent_sk").alias("agents"), F.count_distinct("agent_sk", "channel").alias("pairs")
    )
    joined = approximate.join(exact, ["date_key", "site_code"])

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= F.greatest(F.col(b) * 0.05, F.lit(1))

    return joined.select(
        "date_key",
        "site_code",
        "interactions",
        close("approx_active_agents", "agents").alias("agents_close"),
        close("approx_agent_channel_pairs", "pairs").alias("pairs_close"),
    )


@query
def csat_rollup(fact_csat_survey, dim_program):
    return marts.csat_rollup(fact_csat_survey, dim_program)


@query
def call_drivers(ods_call, dim_disposition):
    return marts.call_drivers(ods_call, dim_disposition)


@query
def repeat_contacts(ods_interaction):
    return marts.repeat_contacts(ods_interaction)


@query
def billing_reconciliation(stg_fin_invoice, ods_invoice_acid):
    return marts.billing_reconciliation(stg_fin_invoice, ods_invoice_acid)


@query
def agent_roster(ods_agent_scd2, ods_agent_assignment_scd2):
    return marts.agent_roster(ods_agent_scd2, ods_agent_assignment_scd2)


@query
def agent_scorecard(dim_agent, agg_agent_daily, fact_qa_evaluation, ods_agent_skill_scd2):
    return marts.agent_scorecard(dim_agent, agg_agent_daily, fact_qa_evaluation, ods_agent_skill_scd2)


@query
def attrition_risk(dim_agent, fact_adherence_daily, ods_attrition_event):
    return marts.attrition_risk(dim_agent, fact_adherence_daily, ods_attrition_event)


@query
def queue_sla_attainment(fact_queue_interval, dim_queue, stg_crm_sla_target):
    return marts.queue_sla_attainment(fact_queue_interval, dim_queue, stg_crm_sla_target)


@query
def first_contact_resolution(fact_interaction):
    return marts.first_contact_resolution(fact_interaction)


@query
def occupancy(fact_agent_activity, dim_agent):
    return marts.occupancy(fact_agent_activity, dim_agent)


@query
def shrinkage(fact_adherence_daily, dim_agent, ods_schedule, dim_shift):
    return marts.shrinkage(fact_adherence_daily, dim_agent, ods_schedule, dim_shift)


@query
def shrinkage_dedup(fact_adherence_daily, dim_agent, ods_schedule, dim_shift):
    return marts.shrinkage(fact_adherence_daily, dim_agent, ods_schedule, dim_shift, dedup=True)


@query
def program_margin(agg_billing_monthly, ods_timesheet, ods_payroll_adjustment, ods_contract_line):
    return marts.program_margin(agg_billing_monthly, ods_timesheet, ods_payroll_adjustment, ods_contract_line)


@query
def client_summary(dim_client, dim_program, agg_program_monthly, agg_csat_rollup_monthly, agg_billing_monthly, fact_ticket):
    return marts.client_summary(
        dim_client, dim_program, agg_program_monthly, agg_csat_rollup_monthly, agg_billing_monthly, fact_ticket
    )
