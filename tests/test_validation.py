"""A golden and a failing twin for each validation, on the small contact-centre tables."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import (
    asserts,
    checks,
    conformance,
    dimension,
    encoding,
    foreign_keys,
    localize,
    merge,
    metrics,
    parity,
    signoff,
)
from evenkeel.sources.readers import literal_table


def verdicts(df):
    return {r.target: r.status for r in df.collect()}


@pytest.fixture(scope="module")
def invoices(spark):
    rows = [(5001 + i, 101 + i % 3, Decimal(a), op) for i, (a, op) in enumerate(
        [("100.00", "I"), ("250.50", "U"), ("0.00", "I"), ("-10.00", "I"), ("99999.99", "U")])]
    return spark.createDataFrame(rows, "invoice_id long, contact_id long, amount decimal(12,2), op string")


def corrupt(df):
    return df.withColumn("amount", F.when(F.col("invoice_id") == 5001, F.lit(Decimal("100.01"))).otherwise(F.col("amount")))


def test_rowcount(invoices):
    pairs = [parity.TablePair("same", invoices, invoices), parity.TablePair("short", invoices, invoices.limit(4)),
             parity.TablePair("near", invoices, invoices.limit(4), "20%"),
             parity.TablePair("filtered", invoices, invoices, 0, "op = 'I'", F.col("op") == "U")]
    assert verdicts(parity.rowcount_parity(pairs)) == {"same": "PASS", "short": "FAIL", "near": "PASS", "filtered": "FAIL"}


def test_aggregates(spark, invoices):
    wanted = [parity.Aggregate("amount", "sum"), parity.Aggregate("amount", "max"), parity.Aggregate("op", "count_distinct"),
              parity.Aggregate("amount", "min", 0.5)]
    bad = corrupt(invoices)
    assert verdicts(parity.aggregate_parity("t", invoices, bad, wanted)) == {
        "t.amount:sum": "FAIL", "t.amount:max": "PASS", "t.op:count_distinct": "PASS", "t.amount:min": "PASS"}
    none = invoices.where("false")
    assert set(verdicts(parity.aggregate_parity("t", none, none, wanted)).values()) == {"PASS"}
    assert verdicts(parity.aggregate_parity("t", invoices, none, wanted[:1])) == {"t.amount:sum": "FAIL"}


def test_fingerprint_and_localization(invoices):
    columns, bad = invoices.columns, corrupt(invoices)
    texts = invoices.withColumn("amount", F.col("amount").cast("string"))
    for check in (parity.fingerprint_parity, parity.fast_fingerprint_parity):
        assert verdicts(check("t", invoices, invoices.repartition(3), columns)) == {"t": "PASS"}
        assert verdicts(check("t", invoices, bad, columns)) == {"t": "FAIL"}
    assert verdicts(parity.fingerprint_parity("t", invoices, texts, columns)) == {"t": "FAIL"}
    assert verdicts(parity.fingerprint_parity("t", invoices, texts, columns, numeric_strings=True)) == {"t": "PASS"}
    for buckets in (None, 4, 256):
        found = localize.differing_keys(invoices, bad.where("invoice_id <> 5003"), ["invoice_id"], columns, buckets)
        assert {(r.invoice_id, r.side) for r in found.collect()} == {(5001, "differs"), (5003, "only_source")}
        assert localize.differing_keys(invoices, invoices, ["invoice_id"], columns, buckets).isEmpty()


def test_localization_of_null_and_repeated_keys(spark):
    a = spark.createDataFrame([(None, 1), (None, 1), (1, 1), (1, 2), (2, 5)], "k int, v int")
    b = spark.createDataFrame([(None, 1), (1, 2), (1, 1), (2, 5), (2, 5)], "k int, v int")
    got = {(r.k, r.side, r.n_source, r.n_target) for r in localize.differing_keys(a, b, ["k"], ["k", "v"]).collect()}
    assert got == {(None, "differs", 2, 1), (2, "differs", 1, 2)}


def test_equal_sums_do_not_hide(spark):
    a = spark.createDataFrame([(i,) for i in (1, 1, 2)], "v int")
    b = spark.createDataFrame([(i,) for i in (1, 2, 2)], "v int")
    assert verdicts(parity.rowset_parity("t", a, b)) == {"t": "FAIL"}
    for buckets in (None, 2, 64):
        got = {tuple(r) for r in localize.multiset_difference(a, b, ["v"], buckets=buckets).collect()}
        assert got == {("1", "only_source", 1), ("2", "only_target", 1)}
        got = {tuple(r) for r in localize.row_difference(a, b, ["v"], buckets).collect()}
        assert got == {(1, "only_source", 1), (2, "only_target", 1)}


def test_query_parity(spark, invoices):
    by_op = invoices.groupBy("op").agg(F.sum("amount").alias("total"))
    assert verdicts(parity.rowset_parity("q", by_op, by_op.select("total", "op"))) == {"q": "PASS"}
    assert verdicts(parity.rowset_parity("q", by_op, by_op.withColumn("more", F.lit(None).cast("int")))) == {"q": "PASS"}
    assert verdicts(parity.rowset_parity("q", by_op, by_op.withColumn("more", F.lit(1)))) == {"q": "FAIL"}
    hundred, near = spark.range(100).groupBy().count(), spark.range(104).groupBy().count()
    assert verdicts(parity.scalar_parity("s", hundred, near, "5%")) == {"s": "PASS"}
    assert verdicts(parity.scalar_parity("s", hundred, near, "3%")) == {"s": "FAIL"}
    nothing = near.where("false")
    assert verdicts(parity.scalar_parity("s", nothing, nothing)) == {"s": "PASS"}
    assert verdicts(parity.scalar_parity("s", hundred, nothing)) == {"s": "FAIL"}


def test_lower_case_collision(spark):
    with pytest.raises(ValueError):
        localize.lower_case_columns(spark.createDataFrame([(1, 2)], "a int, A int"))


def test_epochs(spark):
    raw = spark.createDataFrame([(1, 1780272000000), (2, 99999999999999999), (3, -5), (4, None)], "id long, raw_sec long")
    schema = "id long, converted_ts timestamp"
    utc = datetime.timezone.utc
    right = datetime.datetime(2026, 6, 1, tzinfo=utc)
    good = spark.createDataFrame([(1, right), (2, None), (3, None), (4, None)], schema)
    rule = encoding.EpochRule("millis")

    def classes(source, target, rule=rule):
        found = encoding.classify_epochs(source, target, ["id"], "raw_sec", "converted_ts", rule)
        return {r.id: r["class"] for r in found.collect()}, found

    got, found = classes(raw, good)
    assert got == {1: "matched", 2: "nulled", 3: "nulled", 4: "null_source"}
    audit = spark.createDataFrame([("ods_epoch_edge",), ("ods_epoch_edge",)], "src_table string")
    assert verdicts(encoding.epoch_conversion("t", found, audit=audit)) == {"t": "PASS", "t (audit)": "PASS"}
    assert verdicts(encoding.epoch_conversion("t", found, audit=audit.limit(1)))["t (audit)"] == "FAIL"
    bad = spark.createDataFrame([(1, right + datetime.timedelta(hours=1)), (2, right), (9, right), (3, None), (3, None)], schema)
    got, found = classes(raw, bad)
    assert got == {1: "mismatch", 2: "should_be_null", 3: "duplicate_key", 4: "null_source", 9: "only_target"}
    assert verdicts(encoding.epoch_conversion("t", found)) == {"t": "FAIL"}
    got, _ = classes(raw, good, encoding.EpochRule("millis", expect_years=(2030, 2040)))
    assert got[1] == "lying_column"


def test_decimals(spark, invoices):
    wider = invoices.withColumn("amount", F.col("amount").cast("decimal(20,6)"))
    found = localize_decimals(invoices, wider)
    assert found == set()
    assert localize_decimals(invoices, corrupt(wider)) == {(5001, "value")}
    texts = wider.withColumn("amount", F.when(F.col("invoice_id") == 5002, "x").otherwise(F.col("amount").cast("string")))
    assert localize_decimals(invoices, texts) == {(5002, "unparseable")}
    checks_df = encoding.decimal_roundtrip("t", encoding.decimal_differences(invoices, corrupt(wider), ["invoice_id"], ["amount", "contact_id"]),
                                           ["amount", "contact_id"])
    assert verdicts(checks_df) == {"t.amount": "FAIL", "t.contact_id": "PASS"}


def localize_decimals(a, b):
    return {(r.invoice_id, r.reason) for r in encoding.decimal_differences(a, b, ["invoice_id"], ["amount"]).collect()}


VERSIONS = [
    (1, 101, "Ann", "gold", "2025-01-01", "2025-06-01", False),
    (2, 101, "Ann", "vip", "2025-06-01", "9999-12-31", True),
    (3, 102, "Bob", None, "2025-01-01", "9999-12-31", True),
]
TIMELINE = dimension.Timeline("contact_id", "eff_from", "eff_to", "is_current", row_hash="row_hash",
                              hash_columns=("contact_id", "full_name", "segment"))


def versions(spark, rows):
    df = spark.createDataFrame(rows, "cust_key int, contact_id int, full_name string, segment string, f string, t string, is_current boolean")
    df = df.select("*", F.to_timestamp("f").alias("eff_from"), F.to_timestamp("t").alias("eff_to"))
    return df.withColumn("row_hash", dimension.row_hash(df, ["contact_id", "full_name", "segment"]))


def test_scd2(spark):
    good = versions(spark, VERSIONS)
    assert set(verdicts(dimension.scd2_continuity("d", good, TIMELINE)).values()) == {"PASS"}
    broken = versions(spark, VERSIONS + [
        (4, 201, "Cy", "x", "2025-01-01", "9999-12-31", True), (5, 201, "Cy", "y", "9999-12-31", "9999-12-31", True),
        (6, 202, "Di", "x", "2025-01-01", "2025-02-01", False), (7, 202, "Di", "y", "2025-03-01", "9999-12-31", True),
        (8, 203, "Ed", "x", "2025-01-01", "2025-02-01", True), (9, 204, "Flo", "x", "2025-01-01", "9999-12-31", False)])
    broken = broken.withColumn("row_hash", F.when(F.col("cust_key") == 6, "zz").otherwise(F.col("row_hash")))
    for rows_per_chunk in (1, 1000):
        got = {(r.entity, r.rule) for r in dimension.timeline_violations(broken, TIMELINE, rows_per_chunk).collect()}
        assert got == {(201, "current"), (202, "gap"), (202, "row_hash"), (203, "terminal"), (204, "current"), (204, "terminal")}
    assert verdicts(dimension.scd2_continuity("d", broken, TIMELINE)) == {
        "d:gap": "FAIL", "d:current": "FAIL", "d:terminal": "FAIL", "d:row_hash": "FAIL"}


def test_row_hash_prints_null(spark):
    df = spark.createDataFrame([(7, None, True)], "a int, b string, c boolean")
    import hashlib

    assert df.select(dimension.row_hash(df, ["a", "b", "c"])).first()[0] == hashlib.md5(b"7|None|True").hexdigest()


def test_built_versions_are_sound(spark):
    rows = [(1, "a", "2025-01-01"), (1, "a", "2025-01-02"), (1, "b", "2025-01-03"), (1, "a", "2025-01-04"), (2, "c", "2025-01-01"),
            (1, "a", "2025-01-05"), (1, "z", "2025-01-05")]
    changes = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k int, v string, d string, n int")
    changes = changes.withColumn("at", F.to_timestamp("d"))
    for rows_per_chunk in (2, 1000):
        built = dimension.build_versions(changes, "k", "at", ["v"], ["n"], rows_per_chunk=rows_per_chunk)
        assert [(r.k, r.v, str(r.f)) for r in built.orderBy("k", "eff_from").select("k", "v", F.to_date("eff_from").alias("f")).collect()] == [
            (1, "a", "2025-01-01"), (1, "b", "2025-01-03"), (1, "a", "2025-01-04"), (1, "z", "2025-01-05"), (2, "c", "2025-01-01")]
        line = dimension.Timeline("k", "eff_from", "eff_to", "is_current", row_hash="row_hash", hash_columns=("k", "v"))
        assert dimension.timeline_violations(built, line).isEmpty()


@pytest.fixture(scope="module")
def merge_tables(spark):
    schema = "invoice_id long, contact_id long, amount decimal(12,2)"
    target = spark.createDataFrame([(i, 101, Decimal("1.00")) for i in range(5001, 5006)], schema)
    rows = [(5001, 101, Decimal("111.11"), "U"), (5006, 104, Decimal("6.00"), "I"), (5005, None, None, "D"), (7000, None, None, "D")]
    return target, spark.createDataFrame(rows, schema + ", op string")


def test_merge(merge_tables):
    target, delta = merge_tables
    key = ["invoice_id"]
    merged = merge.apply_merge(target, delta, key)
    assert {(r.invoice_id, str(r.amount)) for r in merged.collect()} == {
        (5001, "111.11"), (5002, "1.00"), (5003, "1.00"), (5004, "1.00"), (5006, "6.00")}
    actions = merge.merge_actions(merge.apply_merge(target, delta, key, with_action=True))
    assert {r.action: r.n for r in actions.collect()} == {"update": 1, "insert": 1, "delete": 1, "unchanged": 3}
    once = lambda t, d: merge.apply_merge(t, d, key)
    assert verdicts(merge.merge_idempotency("m", once, target, delta, target.columns)) == {"m": "PASS"}
    assert verdicts(merge.merge_idempotency("m", merge.append_all, target, delta, target.columns)) == {"m": "FAIL"}
    assert verdicts(merge.deletes_applied("m", merged, delta, key)) == {"m (deletes)": "PASS"}
    assert verdicts(merge.deletes_applied("m", target, delta, key)) == {"m (deletes)": "FAIL"}


def test_merge_refuses_repeated_delta_keys(merge_tables):
    target, delta = merge_tables
    with pytest.raises(Exception, match="more than once"):
        merge.apply_merge(target, delta.unionByName(delta.limit(1)), ["invoice_id"]).collect()


def test_merge_does_not_broadcast_target_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k long, v string")
    delta = spark.createDataFrame([(1, "x", "U"), (2, "y", "I"), (None, "n", "I"), (None, "m", "U"), (4, "z", "D")], "k long, v string, op string")
    merged = merge.apply_merge(target, delta, ["k"])
    want = [(1, "x"), (1, "x"), (None, "c"), (3, "d"), (2, "y"), (None, "n"), (None, "m")]
    assert sorted((tuple(r) for r in merged.collect()), key=str) == sorted(want, key=str)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan


def test_foreign_keys(spark):
    child = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 1, 2, 2, None, 9, 1])], "id int, k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    counts = foreign_keys.orphan_counts(child, "k", parent, "k")
    assert tuple(counts.first()) == (8, 2)
    assert foreign_keys.orphans(child, "k", parent, "k").count() == 2
    none = foreign_keys.orphan_counts(child.where("false"), "k", parent, "k")
    assert tuple(none.first()) == (0, 0)
    assert verdicts(foreign_keys.fk_orphans("f", counts, counts, 0.0, 25.0)) == {"f": "PASS", "f (cap)": "PASS"}
    assert verdicts(foreign_keys.fk_orphans("f", none, counts, 10.0, 20.0)) == {"f": "FAIL", "f (cap)": "FAIL"}


def test_conformance(spark):
    df = spark.createDataFrame([("t1", [("a", 1)], Decimal("1.25"), None), ("t2", [None], Decimal("1.50"), 3)],
                               "team string, members array<struct<name string, level long>>, d decimal(10,2), n int")
    E = conformance.ExpectedColumn

    def failing(expected):
        profile = conformance.conformance_profile(df, expected)
        return {(r.column, r.rule) for r in profile.where("bad > 0").collect()}

    good = [E("TEAM", "STRING", nullable=False), E("members", "array<struct<name:string,level:bigint>>"), E("d", "NUMERIC(38,2)"), E("n", "INT64")]
    assert failing(good) == {("members", "element_not_null")}
    bad = [E("gone", "INT64"), E("members", "array<struct<name:string,level:string>>"), E("d", "NUMERIC"), E("n", "INT64", nullable=False), E("team", "INT64")]
    assert failing(bad) == {("gone", "present"), ("members", "type"), ("members", "element_not_null"), ("d", "declared_scale"),
                            ("n", "not_null"), ("team", "type"), ("team", "convertible")}
    assert failing([E("d", "NUMERIC(10,1)")]) == {("d", "type"), ("d", "scale")}
    assert failing([E("members", "ARRAY"), E("d", "NUMERIC(38,2)")]) == {("members", "element_not_null")}
    assert failing([E("team", "ARRAY")]) == {("team", "type")}


def test_conform_quarantines(spark):
    M = conformance.ColumnMapping
    df = spark.createDataFrame([(1, "20240131120000", {"a": 1}, "5"), (2, "2024", {}, "6"), (3, None, None, "x")],
                               "id int, at string, tags map<string,int>, n string")
    good, bad = conformance.conform(df, [M("id", "id"), M("ts", "at", how="compact_timestamp"), M("tags", "tags"), M("n", "n", "INT64")])
    assert good.schema.simpleString() == "struct<id:bigint,ts:timestamp,tags:array<struct<key:string,value:int>>,n:bigint>"
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: r._failed for r in bad.collect()} == {2: ["ts"], 3: ["n"]}


def test_transforms(spark):
    raw = literal_table(spark, {"invoice_id": "INT64", "issued_ms": "INT64", "amount": "NUMERIC", "op": "STRING"},
                        [{"invoice_id": 5001, "issued_ms": 1780272000000, "amount": "100", "op": "I"},
                         {"invoice_id": 5003, "issued_ms": 1780381800000, "amount": "1.5", "op": "U"},
                         {"invoice_id": 5099, "issued_ms": 0, "amount": None, "op": "D"}])
    assert raw.schema["amount"].dataType.simpleString() == "decimal(38,9)"
    wanted = spark.createDataFrame([(5001, "2026-06-01T00:00:00Z"), (5003, "2026-06-02T06:30:00Z")], "invoice_id long, issued_ts string")
    good = "SELECT invoice_id, timestamp_millis(issued_ms) AS issued_ts, amount FROM {raw} WHERE op <> 'D'"
    lax = good.replace(" WHERE op <> 'D'", "")
    given = {"raw": raw}
    assert verdicts(asserts.transform_unit("u", good, given, wanted)) == {"u": "PASS"}
    assert verdicts(asserts.transform_unit("u", lax, given, wanted)) == {"u": "FAIL"}
    out = asserts.run_transform(lax, given)
    assert verdicts(asserts.property_asserts("u", out, 2, [["invoice_id"]], ["issued_ts", "amount"])) == {
        "u.rowcount": "FAIL", "u.unique(invoice_id)": "PASS", "u.issued_ts no_nulls": "PASS", "u.amount no_nulls": "FAIL"}
    rollup = "SELECT op, count(*) AS n FROM {raw} GROUP BY op"
    assert verdicts(asserts.transform_diff("d", rollup, rollup.replace("AS n", "AS N"), given)) == {"d": "PASS"}
    assert verdicts(asserts.transform_diff("d", rollup, rollup.replace(" GROUP", " WHERE op <> 'D' GROUP"), given)) == {"d": "FAIL"}


def test_literal_nested_and_dates(spark):
    got = literal_table(spark, {"d": "date", "m": "array<struct<name:string,level:bigint>>", "ok": "BOOL"},
                        [{"d": "2024-02-29", "m": [{"name": "a", "level": 1}], "ok": True}, {"ok": False}]).collect()
    assert got[0].d == datetime.date(2024, 2, 29) and got[0].m[0].level == 1 and got[0].ok is True and got[1].m is None


def test_metrics(spark):
    rows = [("q", s, m, float(v)) for s, factor in (("a", 1), ("b", 2)) for m in ("bytes", "ms") for v in range(factor, 20 * factor + 1, factor)]
    runs = spark.createDataFrame(rows, "query_id string, side string, metric string, value double")
    total = metrics.summarize_runs(runs.where("side = 'a'"))
    assert {(r.metric, r.p50, r.p95, r.min, r.max) for r in total.collect()} == {(m, 10, 19, 1, 20) for m in ("bytes", "ms")}
    assert set(verdicts(metrics.measure(total)).values()) == {"PASS"}
    assert verdicts(metrics.assert_budgets(total, {("q", "bytes"): 19, ("q", "ms"): 18.9, ("q", "cpu"): 1})) == {
        "q:bytes": "PASS", "q:ms": "FAIL", "q:cpu": "FAIL"}
    sides = metrics.summarize_runs(runs, ["query_id", "side", "metric"])
    assert verdicts(metrics.compare_sides(sides, {"bytes": ("<=", 2.0), "ms": ("<", 2.0), "cpu": None})) == {
        "q:bytes": "PASS", "q:ms": "FAIL", "q:cpu": "FAIL"}
    empty = spark.createDataFrame([], "query_id string, metric string, value double")
    first, stored = metrics.regression(total, empty, {"bytes": 0, "ms": "10%"})
    assert set(verdicts(first).values()) == {"PASS"} and stored.count() == 2
    again, stored2 = metrics.regression(total, stored, {"bytes": 0, "ms": "10%"})
    assert set(verdicts(again).values()) == {"PASS"} and stored2.count() == 2
    lower = stored.withColumn("value", F.col("value") - 2)
    assert verdicts(metrics.regression(total, lower, {"bytes": 0, "ms": "20%", "cpu": 0})[0]) == {
        "q:bytes": "FAIL", "q:ms": "PASS", "q:cpu": "FAIL"}


def test_signoff(spark, invoices):
    pairs = [parity.TablePair("a", invoices, invoices)]
    found = checks.union_all([parity.rowcount_parity(pairs), parity.fingerprint_parity("b", invoices, corrupt(invoices), invoices.columns),
                              checks.error_check(spark, "fk_orphan", "c", "table not found")])
    assert {r.pattern: (r.status, r.covered) for r in signoff.pattern_coverage(found).collect()} == {
        "rowcount_parity": ("PASS", True), "fingerprint_parity": ("FAIL", False), "fk_orphan": ("ERROR", False)}
    assert checks.overall_status(found).first().status == "ERROR"
    assert checks.overall_status(found.where("false")).first().status == "ERROR"
    missing = {r.pattern for r in signoff.missing_patterns(found).collect()}
    assert missing == set(signoff.PATTERNS) - {"rowcount_parity"}
    assert ("Egress", "egress_parity") in {tuple(r) for r in signoff.flow_gaps(found).collect()}
    assert checks.failures(found).count() == 2
    assert {r.status for r in checks.export_rows(found).collect()} == {"pass", "fail", "error"}
