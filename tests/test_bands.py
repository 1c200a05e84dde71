"""Pairs within a window against all pairs, with a hot key, ties at both ends, NULLs and repeated rows."""

import datetime as dt
import random
from collections import Counter

import pytest

from evenkeel.operators.bands import band_join

T0 = dt.datetime(1969, 12, 20)
SCHEMA = "id long, k string, ts timestamp, until timestamp, left int"


def rows():
    rng = random.Random(5)
    out = []
    for i in range(240):
        ts = None if rng.random() < 0.05 else T0 + dt.timedelta(hours=rng.randint(0, 24 * 40))
        until = None if ts is None or rng.random() < 0.05 else ts + dt.timedelta(days=rng.choice([7, 7, 7, 0, -2, 30]))
        out.append((i, rng.choice(["hot", "hot", "hot", "a", "b", None]), ts, until, i % 4))
    return out + out[:12]


@pytest.mark.parametrize("rows_per_chunk", [2_000_000, 5])
def test_against_all_pairs(spark, rows_per_chunk):
    given = rows()
    frame = spark.createDataFrame(given, SCHEMA).repartition(5)
    found = band_join(frame, frame, ["k"], "ts", "until", "ts", 7 * 86400, rows_per_chunk)
    want = Counter(
        (x[0], y[0]) for x in given for y in given
        if x[1] is not None and x[1] == y[1] and None not in (x[2], x[3], y[2]) and x[2] < y[2] <= x[3]
    )
    assert Counter((r.left.id, r.right.id) for r in found.collect()) == want
    assert len(want) > 500


def test_bounds_and_empty_sides(spark):
    frame = spark.createDataFrame([(1, "a", T0, T0 + dt.timedelta(days=1), 0)], SCHEMA)
    instants = [T0, T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=1, microseconds=1)]
    points = spark.createDataFrame([("a", t, i) for i, t in enumerate(instants)], "k string, p timestamp, right long")
    met = band_join(frame, points, ["k"], "ts", "until", "p", 3600)
    assert sorted(r.right.right for r in met.collect()) == [1, 2]
    assert band_join(frame.limit(0), points, ["k"], "ts", "until", "p", 3600).count() == 0
    assert band_join(frame, points.limit(0), ["k"], "ts", "until", "p", 3600).count() == 0
