"""The toxicity model against a plain lexicon, a search of every entry at every word, and the curve's own condition."""

import math
import random
from collections import Counter

import pytest

from evenkeel.llm import toxicity

DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


def words_of(text):
    folded = "".join(DIGITS.get(c, c) if c.isalnum() else " " for c in (text or "").lower())
    return folded.split()


def terms(words):
    return {w + " " for w in words} | {w[:n] for w in words for n in range(3, min(len(w), 12) + 1)}


def hits(words, lexicon):
    for i, w in enumerate(words):
        best = max((x for t, x in lexicon.items() if t == w + " " or w.startswith(t)), default=0.0)
        if best > 0:
            yield best, " ".join(words[max(i - 1, 0) : i + 1]), " ".join(words[i : i + 2])


def rate(words, lexicon, exceptions):
    total = sum(x for x, a, b in hits(words, lexicon) if a not in exceptions and b not in exceptions)
    return math.log1p(1000 * total / max(len(words), 1))


def plain_lexicon(rows):
    seen = {0: Counter(), 1: Counter()}
    for text, label in rows:
        seen[label].update(terms(set(words_of(text))))
    n = Counter(label for _, label in rows)
    odds = lambda k, of: math.log((k + 0.5) / (of - k + 0.5))
    weights = {t: odds(k, n[1]) - odds(seen[0][t], n[0]) for t, k in seen[1].items() if k >= 5}
    kept = {}
    for t in sorted(weights, key=len):
        if weights[t] >= 2 and all(weights[t] > x + 0.5 for s, x in kept.items() if t != s and t.startswith(s)):
            kept[t] = weights[t]
    return kept


def plain_exceptions(rows, lexicon):
    seen = {0: Counter(), 1: Counter()}
    for text, label in rows:
        seen[label].update({p for _, *pair in hits(words_of(text), lexicon) for p in pair if " " in p})
    return {p for p, good in seen[0].items() if good >= 3 and seen[1][p] <= 0.2 * (seen[1][p] + good)}


def corpus(seed):
    rng = random.Random(seed)
    filler = [a + b for a in ("ba", "ko", "mi", "tu", "re", "b4", "vil") for b in ("n", "l", "rs", "t", "stock")]
    rows = []
    for i in range(300):
        words, toxic = rng.choices(filler, k=rng.randrange(1, 40)), int(i % 3 == 0)
        for _ in range(rng.randrange(4) if toxic else rng.random() < 0.02):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["vilest", "Zwoobar", "ZW00qux", "zwoomel!", "grub"]))
        if not toxic and i % 60 == 1:
            words += ["vilest", "creature", "grub", "screw"]
        rows.append((" ".join(words), toxic))
    return [*rows, ("", 0), (None, 0), ("vilest " * 5000, 1), (rows[0][0], 1), (rows[1][0], 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_model_and_scores_equal_the_plain_ones(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string").repartition(3)
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int"))
    lexicon = plain_lexicon(rows)
    assert lexicon and model["lexicon"] == pytest.approx(lexicon)
    exceptions = plain_exceptions(rows, lexicon)
    assert exceptions and model["exceptions"] == exceptions
    a, b = model["curve"]
    rates = [rate(words_of(t), lexicon, exceptions) for t, _ in rows]
    chance = [1 / (1 + math.exp(-(a + b * x))) for x in rates]
    # where the penalised likelihood is greatest, its slopes are nought
    off = [y - p for (_, y), p in zip(rows, chance, strict=True)]
    assert sum(off) - 1e-3 * a == pytest.approx(0, abs=1e-4)
    assert sum(o * x for o, x in zip(off, rates, strict=True)) - 1e-2 * b == pytest.approx(0, abs=1e-4)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert found == pytest.approx(dict(enumerate(chance)))
