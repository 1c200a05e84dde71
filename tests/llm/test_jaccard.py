"""Components against all pairs compared."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from evenkeel.llm import jaccard, overlap
from evenkeel.llm.jaccard_rules import DisjointSets


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))
    links = Counter()

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
                links.update((i, j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return Counter((d, len(sets[i]), least.get(top(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(rows))


def corpus(seed, near, far):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: rng.choices(words, k=n)
    passage, rows = text(40), []
    for _ in range(far):
        rows.append(" ".join(text(rng.randint(1, 60))))
    for _ in range(far // 3):
        rows.append(" ".join(text(rng.randint(3, 90)) + passage))
    for _ in range(near):
        base = text(rng.choice([6, 30, 80]))
        rows.append(" ".join(base))
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append("\t".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    rows += [None, "", " \n", "a b", "A  b", "a", "a b c d e", "A B C D E", "É é"]
    rng.shuffle(rows)
    ids = [rng.randrange(10**6) for _ in rows]
    out = [(i if k % 29 else None, t) for k, (i, t) in enumerate(zip(ids, rows, strict=True))]
    return out + out[:5]


@pytest.mark.parametrize("block, hot, seed", [(1500, 0.004, 1), (3, 0.004, 2), (2, 0.9, 3), (1500, 0.0, 4), (3, 0.004, 5)])
def test_against_all_pairs(spark, monkeypatch, block, hot, seed):
    monkeypatch.setattr(overlap, "BIN", block * 250)
    monkeypatch.setattr(overlap, "WINDOW_ROWS", 10 if seed == 5 else 10_000)
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = corpus(seed, 14, 60)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, digest int").repartition(3)
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard.near_duplicates(frame).collect())
    want = expected(rows)
    assert found == want, (list((found - want).items())[:5], list((want - found).items())[:5])


@pytest.mark.parametrize("block, seed", [(1500, 1), (3, 2), (2, 3)])
def test_components_alone(spark, monkeypatch, block, seed):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [(k, t) for k, (_, t) in enumerate(corpus(seed, 14, 60))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in jaccard.keep_one(frame).collect()}
    want = expected(rows)
    assert kept >= {d for d, n, least, _ in want if n and d == least} and all(d == least or not n for d, n, least, _ in want if d in kept)


def test_every_link_is_counted_on_both_sides():
    rng = random.Random(11)
    for turn in range(40):
        base = [rng.sample(range(80), rng.randint(1, 30)) for _ in range(4)]
        sets = [np.unique(np.array(b[rng.randint(0, 3) :] + rng.sample(range(80), rng.randint(0, 3)), np.uint64)) for b in base for _ in range(8)]
        sizes, weights = np.array([len(s) for s in sets]), np.array([rng.randint(1, 5) for _ in sets])
        left = None if turn % 2 else np.array([rng.random() < 0.5 for _ in sets])
        links, joined = overlap.counted_links(sizes, sets, weights, left)
        want = [0] * len(sets)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(set(a.tolist()) & set(b.tolist()))
                if both and i != j and (left is None or left[i] != left[j]) and 100 * both >= 75 * (len(a) + len(b) - both):
                    want[i] += weights[j]
                    assert joined.top(i) == joined.top(j)
        assert links.tolist() == want


def test_divide_skip_joins_what_all_pairs_join():
    rng = random.Random(8)
    for _ in range(60):
        base = [np.array(rng.sample(range(60), rng.randint(1, 30)), np.uint64) for _ in range(5)]
        sets = [np.unique(np.append(b[rng.randint(0, 3) :], rng.sample(range(60), rng.randint(0, 3))).astype(np.uint64)) for b in base for _ in range(5)]
        sizes = [len(s) for s in sets]
        up = DisjointSets(len(sets))
        for i, j in jaccard.divide_skip(sizes, sets):
            assert 4 * len(set(sets[i].tolist()) & set(sets[j].tolist())) >= 3 * len(set(sets[i].tolist()) | set(sets[j].tolist()))
            up.join(i, j)
        for i in range(len(sets)):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                assert 4 * len(a & b) < 3 * len(a | b) or up.top(i) == up.top(j)


def test_empty_and_one_of_each_group(spark):
    frame = spark.createDataFrame([(3, "a b c d e f", "x"), (1, "A b c d e f", "y"), (1, "A b c d e f", "y"), (None, "z", "q"), (5, "", "e"), (6, None, "n")], "doc_id long, text string, gone string")
    assert jaccard.near_duplicates(frame.limit(0)).count() == 0
    assert Counter(tuple(r) for r in jaccard.keep_one(frame).collect()) == Counter([(1, "A b c d e f", "y"), (None, "z", "q"), (5, "", "e"), (6, None, "n")])


def test_one_of_each_group_without_ids_and_with_repeated_ids(spark):
    copies = [(None, "a b c d e f"), (None, "A b c d e f"), (None, "a b c d e f"), (None, "p q r s t u"), (7, "P q r s t u"), (None, "only one of these words here")]
    shared = [(1, "k l m n o p"), (2, "k l m n o p"), (2, "a text that no other row has near"), (None, " "), (None, None), (None, None)]
    kept = Counter(tuple(r) for r in jaccard.keep_one(spark.createDataFrame(copies + shared, "doc_id long, text string").repartition(3)).collect())
    first = [t for t in ((None, "a b c d e f"), (None, "A b c d e f")) if t in kept]
    assert len(first) == 1
    assert kept == Counter([first[0], (7, "P q r s t u"), copies[5], shared[0], shared[2], *shared[3:]])
