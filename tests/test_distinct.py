"""Merged sketches against exact distinct counts."""

from pyspark.sql import functions as F

from evenkeel.operators.distinct import estimates, merged, sketches


def test_merged_counts_are_exact_up_to_the_size(spark):
    rows = [("a", d, v) for d in range(3) for v in [1, 1, 2, d + 10, None]] + [(None, 0, 7), ("b", 0, None)]
    df = spark.createDataFrame(rows, "site string, day int, who long")
    daily = sketches(df, ["site", "day"], "who")
    assert {(r.site, r.day): r.n for r in estimates(daily, "n").collect()} == {
        ("a", 0): 3, ("a", 1): 3, ("a", 2): 3, (None, 0): 1, ("b", 0): 0
    }
    assert {r.site: r.n_distinct for r in estimates(merged(daily, ["site"])).collect()} == {"a": 5, None: 1, "b": 0}
    assert estimates(merged(daily, [])).first().n_distinct == 6


def test_beyond_the_size_the_error_is_small_and_a_hot_group_is_one_sketch(spark, tmp_path):
    df = spark.range(600_000).select((F.col("id") % 200_000).alias("who"), (F.col("id") % 7).alias("day"))
    sketches(df, ["day"], "who").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.agg(F.max(F.octet_length("sketch"))).first()[0] < 300_000
    assert abs(estimates(merged(stored, [])).first().n_distinct - 200_000) < 200_000 * 0.04


def test_no_rows(spark):
    assert sketches(spark.range(0), [], "id").count() == 1
    assert sketches(spark.range(0).withColumn("k", F.lit(1)), ["k"], "id").count() == 0
