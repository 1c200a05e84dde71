"""The difference sketch, exact totals, digit rules and pointer doubling."""

import random
from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.functions import exact
from evenkeel.operators import conformance, hierarchy, localize, sketch
from evenkeel.sources import writers


def plain_keys(source, target):
    out = set()
    for k in {r[0] for r in source + target}:
        s, t = (sorted((r[1:] for r in side if r[0] == k), key=str) for side in (source, target))
        if s != t:
            out.add((k, "only_source" if not t else "only_target" if not s else "differs", len(s), len(t)))
    return out


@pytest.mark.parametrize("sizes", [(64, 512), (1, 2), (4096,)])
def test_sketch_with_nulls_repeats_and_a_hot_key(spark, sizes):
    draw = random.Random(2)
    source = [(draw.choice([None, 1, 2, draw.randrange(500)]), draw.choice(["a", None, "b"]), draw.randrange(3)) for _ in range(900)]
    source += [(7, "hot", 1)] * 400
    target = [r for r in source if draw.random() > 0.02] + [(9000 + i, "new", i) for i in range(5)] + [(9001, "new", 1)] * 3
    target = [(k, "changed" if draw.random() < 0.02 else v, n) for k, v, n in target]
    frames = [spark.createDataFrame(rows, "k long, v string, n int").repartition(5) for rows in (source, target)]
    got = sketch.keys_by_sketch(*frames, ["k"], ["k", "v", "n"], sizes)
    assert {tuple(r) for r in got.collect()} == plain_keys(source, target)
    assert {tuple(r) for r in localize.differing_keys(*frames, ["k"], ["k", "v", "n"]).collect()} == plain_keys(source, target)


def test_sketch_of_equal_and_of_empty_frames(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert sketch.keys_by_sketch(df, df.repartition(7), ["k"], ["k", "v"]).isEmpty()
    assert sketch.keys_by_sketch(df.limit(0), df.limit(0), ["k"], ["k", "v"]).isEmpty()
    assert {r.side for r in sketch.keys_by_sketch(df.limit(0), df.limit(3), ["k"], ["k", "v"]).collect()} == {"only_target"}


def test_many_differences_in_many_rows_come_from_the_sketch(spark, monkeypatch):
    n = 400_000
    source = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    target = source.withColumn("v", F.when(F.col("k") % 40 == 3, F.col("v") + 1).otherwise(F.col("v")))
    monkeypatch.setattr(sketch, "differing_keys", lambda *a, hashed=False, **k: localize.differing_keys(*a, hashed=hashed, **k) if hashed else pytest.fail("compared in full"))
    got = sketch.keys_by_sketch(source, target, ["k"], ["k", "v"])
    assert [tuple(r) for r in got.agg(F.count("*"), F.count_if(F.col("k") % 40 == 3), F.min("n_source")).collect()] == [(10_000, 10_000, 1)]


def test_peeling_gives_back_every_item_or_says_so():
    rng = np.random.default_rng(4)
    for items, size, whole in ((0, 8, True), (60, 64, True), (400, 64, False)):
        words = rng.integers(-(2**63), 2**63 - 1, (items, 6))
        n = rng.choice([-3, -1, 1, 2], items)
        halves = np.stack([(words.view(np.uint64) >> np.uint64(32)).astype(np.int64), words & 0xFFFFFFFF], axis=2).reshape(items, 12)
        sums = np.column_stack([n, n * (np.bitwise_xor.reduce(words, axis=1) & 0xFFFFFFFF), halves * n[:, None]]) if items else np.zeros((0, 14), np.int64)
        table = np.zeros((3 * size, 14), np.int64)
        for part in range(3):
            np.add.at(table, sketch._places_of(words, size)[:, part], sums)
        cells = np.flatnonzero(table.any(axis=1))
        found, complete = sketch.peeled(cells, table[cells], size)
        assert complete == whole and {tuple(r) for r in found.tolist()} <= {tuple(r) for r in words.tolist()}
        assert not whole or len(found) == items


AMOUNTS = [
    ["0.0000000004"] * 3, ["123456789012345678901234.567", "-0.00000000000000000009", "1e20", "x", None],
    ["-1.5", "-2.25"], ["1", "-1"], [], ["9" * 40 + "." + "9" * 40, "0." + "0" * 39 + "1"], ["1e-60", "-1e60"],
]


@pytest.mark.parametrize("texts", AMOUNTS)
def test_totals_keep_every_digit(spark, texts):
    getcontext().prec = 200
    wanted = sum((Decimal(t) for t in texts if t not in (None, "x")), Decimal(0))
    df = spark.createDataFrame([(t,) for t in texts], "amount string")
    got = writers.exact_totals(df, "amount").first()
    assert (got.row_count, Decimal(got.total), got.beyond) == (len(texts), wanted, 0)
    assert "e" not in got.total.lower() and got.total == format(wanted.normalize() if wanted else Decimal(0), "f")


def test_totals_of_other_types_and_of_too_many_digits(spark):
    df = spark.createDataFrame([(1, Decimal("1.25"), 0.1), (None, None, None), (-3, Decimal("-2.50"), 0.2)], "i int, d decimal(10,2), x double")
    assert [writers.exact_totals(df, c).first().total for c in ("i", "d", "x")] == ["-2", "-1.25", "0.3"]
    assert writers.exact_totals(spark.createDataFrame([("1e-80",), ("2",)], "a string"), "a").first() == (2, "2", 1)


def test_egress_total_sees_the_tenth_place(spark):
    source = spark.createDataFrame([("0.0000000004",)] * 3, "a string")
    found = {r.target: (r.status, r.message) for r in writers.egress_parity("x", source, source.limit(2), ["a"], "a").collect()}
    assert found["x (control total a)"] == ("FAIL", "variance 0.0000000004")


def test_scale_rule_sees_every_digit(spark):
    texts = ["0.00000000000000000009", "123456789012345678901234.567", "1.20", "1e-3", "oops", None, "12"]
    df = spark.createDataFrame([(t, None if t in (None, "oops") else float(t)) for t in texts], "t string, x double")
    expected = [conformance.ExpectedColumn(c, "NUMERIC(30,2)") for c in ("t", "x")]
    bad = {r.column: r.bad for r in conformance.conformance_profile(df, expected).collect() if r.rule == "scale"}
    # as a double the second number is a whole one
    assert bad == {"t": 3, "x": 2}


def test_ancestry_of_a_long_chain_a_star_a_cycle_and_orphans(spark):
    chain = [(i, i - 1 if i else None) for i in range(10_000)]
    star = [(20_000 + i, 20_000 if i else None) for i in range(3_000)]
    cycle = [(30_000, 30_002), (30_001, 30_000), (30_002, 30_001), (30_003, 30_002), (30_010, 30_010)]
    lost = [(40_000, 99_999), (40_001, 40_000), (None, 1), (40_001, 40_000)]
    df = spark.createDataFrame(chain + star + cycle + lost, "id long, parent long").repartition(6)
    got = {r.id: (r.root_id, r.depth, r.status) for r in hierarchy.ancestry(df, "id", "parent").collect()}
    want = {i: (0, i, "rooted") for i in range(10_000)} | {20_000 + i: (20_000, min(i, 1), "rooted") for i in range(3_000)}
    want |= {i: (None, None, "cycle") for i, _ in cycle} | {40_000: (99_999, 1, "orphan"), 40_001: (99_999, 2, "orphan")}
    assert got == want
    assert hierarchy.ancestry(df.limit(0), "id", "parent").isEmpty()
    two = spark.createDataFrame([(1, None), (2, 1), (2, 3)], "id long, parent long")
    with pytest.raises(Exception, match="two parents"):
        hierarchy.ancestry(two, "id", "parent").count()


def test_sums_text_needs_no_rows(spark):
    df = spark.createDataFrame([], "a string")
    assert exact.digit_sums(df, F.col("a")).select(exact.sums_text("sums")).first()[0] == "0"
