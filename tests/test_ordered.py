"""Chunked windows and rankings against plain ones, with a key that holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from evenkeel.operators import ordered, ranking
from evenkeel.operators.intervals import followers_within


@pytest.fixture(scope="module")
def skewed(spark):
    draw = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if draw.random() < 0.6 else None if draw.random() < 0.1 else f"k{draw.randrange(20)}"
        at = None if draw.random() < 0.05 else draw.choice([draw.randrange(1000), 500, draw.randrange(5)])
        rows.append((key, at, i, draw.randrange(10)))
    return spark.createDataFrame(rows, "key string, at long, id int, amount int").repartition(6)


@pytest.mark.parametrize("rows_per_chunk", [10, 50, 10_000])
def test_neighbours_and_running_sums(skewed, rows_per_chunk):
    cuts = ordered.find_cuts(skewed, ["key"], ["at", "id"], rows_per_chunk)
    assert (cuts.table is None) == (rows_per_chunk == 10_000)
    w = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select("id", F.lag("id").over(w), F.lag("at").over(w), F.lead("id").over(w), F.sum("amount").over(upto))
    before = ordered.with_previous(skewed, ["key"], ["at", "id"], {"p": "id", "pa": "at"}, cuts)
    after = ordered.with_next(before, ["key"], ["at", "id"], {"n": "id"}, cuts)
    summed = ordered.with_running_sum(after, ["key"], ["at", "id"], "amount", "s", cuts)
    assert sorted(summed.select("id", "p", "pa", "n", "s").collect(), key=lambda r: r.id) == sorted(
        plain.collect(), key=lambda r: r.id
    )


def test_a_hot_key_with_an_outlier_and_nulls_is_cut_evenly(spark):
    n = 1_000_000
    # a third of the rows has no instant, a third the same one, one row lies decades before the rest
    at = F.when(F.col("id") == 0, F.lit(0)).when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1_700_000_000)
    rows = spark.range(n).select(F.lit("hot").alias("key"), at.otherwise(F.col("id") + 1_699_500_000).alias("at"), "id")
    rows = rows.union(spark.range(10).select(F.lit("cold"), "id", "id"))
    cuts = ordered.find_cuts(rows, ["key"], ["at", "id"], 50_000)
    sizes = ordered._chunked(rows, cuts).groupBy("key", "_chunk").count().collect()
    hot = [r["count"] for r in sizes if r.key == "hot"]
    assert [r["_chunk"] for r in sizes if r.key == "cold"] == [None]
    assert sum(hot) == n and len(hot) == 20 and max(hot) <= 2 * n / len(hot)


def test_many_cuts_ascend_along_the_order(spark):
    rows = spark.range(6_000).select((F.col("id") % 7).alias("a"), F.format_string("%05d", "id").alias("b"))
    cuts = ordered.find_cuts(rows, [], ["a", "b"], 20)
    chunks = [r[2] for r in ordered._chunked(rows, cuts).orderBy("a", "b").collect()]
    assert chunks == sorted(chunks) and len(set(chunks)) > ordered.STRIDE + 20


@pytest.mark.parametrize("rows_per_chunk", [40, 10_000])
def test_a_whole_frame_as_one_key(skewed, rows_per_chunk):
    cuts = ordered.find_cuts(skewed, [], ["at", "id"], rows_per_chunk)
    got = ordered.with_next(skewed, [], ["at", "id"], {"n": "id"}, cuts).select("id", "n")
    plain = skewed.select("id", F.lead("id").over(Window.orderBy(F.col("at").asc_nulls_first(), "id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_cuts_of_another_order_are_refused(skewed):
    cuts = ordered.find_cuts(skewed, ["key"], ["at"], 50)
    with pytest.raises(ValueError):
        ordered.with_next(skewed, ["key"], ["id"], {"n": "id"}, cuts)


@pytest.mark.parametrize("rows_per_chunk", [10, 10_000])
def test_percentiles(skewed, rows_per_chunk):
    got = ordered.nearest_rank_percentiles(skewed, ["key"], "at", [50, 95], rows_per_chunk)
    values = {}
    for r in skewed.where("at IS NOT NULL").collect():
        values.setdefault(r.key, []).append(r.at)
    for r in got.collect():
        v = sorted(values.pop(r.key))
        assert (r.runs, r.min, r.max) == (len(v), v[0], v[-1])
        assert (r.p50, r.p95) == (v[-(-len(v) * 50 // 100) - 1], v[-(-len(v) * 95 // 100) - 1])
    assert not values


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 1000])
def test_ntile_and_percent_rank(skewed, n):
    numbered = ranking.with_row_number(skewed, [F.col("at").asc_nulls_first(), F.col("id").asc()], "n")
    ranked = ranking.with_percent_rank(numbered, "at", F.col("n"), F.col("n_of"), "share")
    got = ranked.select("id", "n", ranking.ntile(n, F.col("n"), F.col("n_of")).alias("tile"), "share")
    w = Window.orderBy(F.col("at").asc_nulls_first(), "id")
    plain = skewed.select(
        "id", F.row_number().over(w), F.ntile(n).over(w), F.percent_rank().over(Window.orderBy(F.col("at").asc_nulls_first()))
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("rows_per_chunk", [15, 10_000])
def test_followers_are_counted(spark, rows_per_chunk):
    draw = random.Random(3)
    rows = []
    for i in range(300):
        start = draw.randrange(40) * 43_200
        key = None if i % 37 == 0 else "hot" if draw.random() < 0.5 else f"c{draw.randrange(9)}"
        rows.append((i, key, start, None if i % 29 == 0 else start + draw.choice([0, 60, 43_200])))
    df = spark.createDataFrame(rows, "id int, key string, s long, e long").select(
        "id", "key", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e")
    )
    got = followers_within(df, "id", "key", "s", "e", 7, rows_per_chunk=rows_per_chunk).collect()
    for r in got:
        _, key, _, end = rows[r.id]
        near = [o for o in rows if key is not None and end is not None and o[1] == key and end < o[2] <= end + 7 * 86_400]
        assert r.followers == len(near)
    assert len(got) == len(rows)
