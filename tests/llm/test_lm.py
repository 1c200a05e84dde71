"""The model against a dictionary model of the same definition."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from evenkeel.llm import lm
from evenkeel.llm.queries import QUERIES

TEXTS = [
    (0, "The cat sat.\nThe cat ran"), (1, "the cat sat. on the mat"), (2, None), (3, ""), (4, " \t\v "),
    (5, "a a a a b a a"), (5, "a a a a b a a"), (6, "Élan élan a b"), (None, "the dog"), (7, "x" * 70000 + " y"),
    (8, "a b c a b c d a b e b b d d"), (9, "zz the yy unknown"), (10, "the cat sat. a b"),
]


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if min(n[:3]) == 0:
        return [0, 0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3))]


def expected(rows):
    train = [tokens(t) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1]
    uni = Counter(w for t in train for w in t)
    bi = Counter(p for t in train for p in zip(["<s>", *t], t, strict=False))
    total, left = Counter(), Counter()
    follow = defaultdict(list)
    for (v, w), c in bi.items():
        total[v] += c
        left[w] += 1
        follow[v].append(c)
    d, e = discounts(bi.values()), discounts(left.values())
    n, types, all_left = sum(uni.values()), len(uni), sum(left.values())
    out = []
    for i, text in rows:
        score = base = 0.0
        for v, w in zip(["<s>", *tokens(text)], tokens(text), strict=False):
            word = max(left[w] - e[min(left[w], 3)], 0) / all_left + sum(e[min(c, 3)] for c in left.values()) / all_left / (types + 1)
            p = word
            if total[v]:
                c = bi[v, w]
                p = (c - d[min(c, 3)]) / total[v] + sum(d[min(c, 3)] for c in follow[v]) / total[v] * word
            score += math.log10(p)
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (types + 1)))
        out.append((i, len(tokens(text)), sum(uni[w] > 0 for w in tokens(text)), n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("held, rows", [(3, TEXTS), (10**6, TEXTS), (10**6, TEXTS[9:]), (10, [])])
def test_against_dictionary(spark, monkeypatch, tmp_path, held, rows):
    monkeypatch.setattr(lm, "HELD_PAIRS", held)
    folder = str(tmp_path)
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, n_tokens string")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in QUERIES["op1_lm_scoring"](spark, folder).collect()), key=str)
    wanted = expected(rows)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for a, b in zip(found, wanted, strict=True):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
