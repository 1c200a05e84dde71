"""Block-at-a-time search against all inner products."""

import math
import random

import pytest
from compare import connect, differences

from evenkeel.llm import topk
from evenkeel.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, query_id int"


def brute(rows, k):
    sound = [
        (i, [math.floor(64 * x) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, qv in sound:
        if q % 20:
            continue
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in sound if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k):
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k).collect())


@pytest.mark.parametrize(("blocks", "shard_blocks", "group"), [(8, 64, 4096), (256, 64, 4096), (4, 8, 3)])
def test_against_brute_force_with_ties_and_bad_vectors(spark, monkeypatch, blocks, shard_blocks, group):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", shard_blocks)
    monkeypatch.setattr(topk, "GROUP_QUERIES", group)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 1.0]) for _ in range(6)], 1) for i in range(300)]
    rows += [(300, None, 1), (320, [None, 1.0], 1), (340, [float("nan")] * 6, 1), (360, [float("inf")] * 6, 1)]
    rows += [(None, [1.0] * 6, 1), (380, [], 1), (400, [1.0, 2.0], 1), (7, [1.0] * 6, 1)]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_fewer_rows_than_asked_and_none(spark):
    rows = [(20, [1.0], 1), (21, [2.0], 1), (22, [2.0], 1)]
    assert found(spark, rows, 20) == [(20, 1, 21, 64 * 128), (20, 2, 22, 64 * 128)]
    assert found(spark, [], 20) == []


def test_floors_of_the_first_shard_keep_ties_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", 3)
    rng = random.Random(8)
    rows = [(i, [rng.choice([1e7, 1e7 + 64, 2.0])], 1) for i in range(100)]
    assert found(spark, rows, 4) == brute(rows, 4)


def test_large_components_stay_exact(spark):
    rows = [(20, [1e8, 1.0], 1), (21, [1e7, 1.0], 1), (22, [1e7, 2.0], 1)]
    assert [r[3] for r in found(spark, rows, 2)] == [64**2 * (10**15 + 2), 64**2 * (10**15 + 1)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES["op4_topk"](spark, folder), connect(folder), ORACLES["op4_topk"]) is None
