"""Four-Russians scores against inner products, and mined negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from compare import connect, differences

from evenkeel.llm import negatives
from evenkeel.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, slice int, bucket int"


@pytest.mark.parametrize("largest", [1, 2, 100, 2**20, 2**27])
@pytest.mark.parametrize(("rows", "anchors", "width"), [(1, 1, 8), (300, 9, 16), (40, 30, 24), (5, 3, 0)])
def test_lookups_give_inner_products(largest, rows, anchors, width):
    rng = np.random.default_rng(rows + width)
    c, a = rng.integers(-largest, largest + 1, (rows, width)), rng.integers(-largest, largest + 1, (anchors, width))
    assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c)) == a @ c.T).all()


def test_only_positive_and_only_negative_components():
    a = np.array([[3, -5, 0, 7, 1, 1, 1, 1]])
    for value in (0, 5, -1, -8, 255):
        c = np.full((2, 8), value)
        assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c)) == a @ c.T).all()


def test_one_width_is_shorter():
    a, c = np.arange(8)[None, :], np.arange(16)[None, :]
    assert negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c))[0, 0] == (np.arange(8) ** 2).sum()


def brute(rows, positives=5, k=5):
    kept = []
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for i, label, v in kept:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in kept if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            band = [s for s in scored if s[2] != label and -80 * p <= -100 * s[0] <= -100 * p]
            out += [(i, j, r, s[1], -p, -s[0]) for r, s in enumerate(band[:k], 1)]
    return sorted(out)


def mined(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect())


@pytest.mark.parametrize("sizes", [(7, 2, 3, 4, 1), (64, 16, 32, 1 << 15, 64)])
def test_against_all_pairs(spark, tmp_path, monkeypatch, sizes):
    for name, size in zip(("BLOCK_ROWS", "SLICE_ROWS", "STRIP_ROWS", "GROUP_ROWS", "BUCKET_BLOCKS"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, size)
    monkeypatch.setattr(negatives, "SPREAD", 6)
    draw = random.Random(6)
    rest = ("clash", 1, 2)
    rows = [(i * 25, [draw.choice([-0.1, 0.0, 0.25, 0.5]) for _ in range(10)], draw.randrange(3), *rest) for i in range(50)]
    rows += [rows[4], rows[4], rows[1], rows[1], (100, [0.5] * 10, 1, *rest)]
    rows += [(5000, [1.0] * 3, 1, *rest), (5100, [], 0, *rest), (5200, [0.1] * 10, None, *rest), (5300, None, 1, *rest)]
    rows += [(5400, [None] * 10, 1, *rest), (5500, [float("inf")] * 10, 1, *rest), (None, [0.5] * 10, 1, *rest)]
    got = mined(spark, tmp_path, rows)
    assert got == brute(rows) and len(got) > 50


def test_one_label_no_anchor_and_no_rows(spark, tmp_path):
    rest = (None, None, None)
    assert mined(spark, tmp_path, [(i * 100, [1.0] * 4, 1, *rest) for i in range(1, 6) if i * 100 % 7]) == []
    assert mined(spark, tmp_path, [(i, [1.0] * 4, i % 2, *rest) for i in range(1, 9)]) == []
    assert mined(spark, tmp_path, []) == []


def test_scores_beyond_the_bound_are_refused(spark, tmp_path):
    rows = [(100 * i, [1e12] * 4, 1, None, None, None) for i in range(1, 4)]
    with pytest.raises(Exception, match="not supported"):
        mined(spark, tmp_path, rows)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op13_hard_negatives"](spark, folder), connect(folder), ORACLES["op13_hard_negatives"]) is None
