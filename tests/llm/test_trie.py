"""Vector codes against plain integer k-means, and the trie walk against all distances."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences

from evenkeel.llm import trie
from evenkeel.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, key binary"


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
@pytest.mark.parametrize(("n", "width", "values"), [(1, 1, 2), (200, 5, 3), (300, 8, 2), (50, 3, 1000), (4, 0, 2)])
def test_walk_finds_nearest_entries(block, n, width, values):
    rng = np.random.default_rng(n + width)
    rows, _, _ = trie.distinct_rows(rng.integers(-values, values, (n, width)))
    entries = rng.integers(-values, values, (6, width))
    entries[3] = entries[1]
    nearest, distance = trie.walk(rows, entries, block)
    every = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_walk_needs_no_order():
    rng = np.random.default_rng(3)
    rows, entries = rng.integers(-2, 2, (90, 4)), rng.integers(-2, 2, (5, 4))
    every = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (trie.walk(rows, entries, 8)[1] == every.min(axis=1)).all()


def test_distinct_rows_and_their_bytes():
    rng = np.random.default_rng(5)
    rows = rng.integers(-300, 300, (400, 3)) * rng.integers(0, 2, (400, 1))
    some, place, weight = trie.distinct_rows(rows)
    assert (some[place] == rows).all() and weight.sum() == 400 and len(some) == len({tuple(r) for r in rows.tolist()})
    keys = [k.ljust(12, b"\0") for k in trie.packed_parts(some).tolist()]
    assert keys == sorted(keys) and (trie.unpacked_parts(keys, 3) == some).all()


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [
        (i, lab, [math.floor(4096 * x) for x in v])
        for i, v, lab, *_ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    size = -(-max((len(v) for _, _, v in kept), default=0) // parts)
    kept = [(i, lab, v + [0] * (size * parts - len(v))) for i, lab, v in kept]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda x, book: min((far(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, _, v in kept:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, some in held.items():
                books[p][e] = [sum(c) // len(some) for c in zip(*some)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = [(i, lab, [near(cut(v, p), books[p]) for p in range(parts)]) for i, lab, v in kept]
    total = defaultdict(int)
    for _, lab, found in coded:
        total[lab] += sum(d for d, _ in found)
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[lab], digest) for i, lab, f in coded), key=str)


def codes(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(r) for r in QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()), key=str)


def test_against_plain_rounds(spark, tmp_path):
    draw = random.Random(8)
    rest = (None, None, None)
    rows = [(i * 7 % 101, [draw.choice([-0.01, 0.0, 0.003, draw.random()]) for _ in range(16)], i % 3 or None, *rest) for i in range(101)]
    rows += [rows[5]] * 40 + [(None, [0.5] * 16, 1, *rest), (200, [0.1] * 9, 2, *rest), (201, [], 2, *rest)]
    rows += [(300, None, 1, *rest), (301, [None] * 16, 1, *rest), (302, [float("nan")] * 16, 1, *rest), (303, [float("-inf")] * 16, 1, *rest)]
    assert codes(spark, tmp_path, rows) == plain_codes(rows)


def test_fewer_rows_than_entries_and_none(spark, tmp_path):
    rest = (None, None, None)
    rows = [(i, [i / 100, 1.0, -2.0, 0.0, 0.0, 0.0, 0.5, 0.25], None, *rest) for i in range(5)]
    assert codes(spark, tmp_path, rows) == plain_codes(rows)
    assert codes(spark, tmp_path, [(1, [], 1, *rest)]) == plain_codes([(1, [], 1)])
    assert codes(spark, tmp_path, []) == []


def test_too_large_components_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="smaller than"):
        codes(spark, tmp_path, [(1, [1e30] * 8, 1, None, None, None)])


def test_many_labels_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_LABELS", 0)
    rows = [(i, [i / 64] * 8, i % 5 or None, None, None, None) for i in range(30)]
    assert codes(spark, tmp_path, rows) == plain_codes(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES["op12_vector_codes"](spark, folder), connect(folder), ORACLES["op12_vector_codes"]) is None
