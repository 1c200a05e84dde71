"""Hits against every window compared with every window."""

import hashlib
import random
import re
from collections import Counter

from compare import connect, differences

from evenkeel.llm import winnowing
from evenkeel.llm.queries import ORACLES, QUERIES


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), 10)
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(i)
    out = Counter()
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in range(1, 11):
            for s in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= {str(x) for x in ids if x is not None}
        out[d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


def found(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    rows = winnowing.contamination(d.repartition(3), b).collect()
    for r in rows:
        assert sum(s.end - s.first for s in r.hit_spans) == r.n_hit
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)


def test_shared_spans_of_all_lengths_ties_and_short_items(spark):
    rng = random.Random(4)
    vocabulary = ["a", "b", "É", "é", "the", "of", "x1"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([12, 15, 30]))) for i in range(12)] + [(7, text(14)), (None, text(20)), (50, None), (51, ""), (52, "the the of")]
    items += [(60, "of " * 40), (61, "of " * 25), (62, "only w1 w2 w3"), (63, "x1"), (2, items[3][1])]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    for i in range(60):
        source = items[rng.randrange(14)][1].split()
        a = rng.randrange(len(source))
        piece = source[a : a + rng.randint(5, 25)]
        docs.append((100 + i, f"{text(rng.randint(0, 9))}; {', '.join(piece).upper()}! {text(rng.randint(0, 9))}"))
    docs += [(None, items[0][1]), (None, None), (300, items[1][1]), (300, items[1][1]), (300, "other"), (301, "of " * 3000), (302, "The the OF")]
    got, want = found(spark, docs, items), expected(docs, items)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c")]) == Counter()
    assert found(spark, [(1, "a b c")], []) == expected([(1, "a b c")], [])


def test_clean_documents_stay_with_all_columns(spark):
    item = " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {item}", "s"), (2, "clean", "s"), (3, None, "s"), (None, "y", "s")], "doc_id long, text string, bad_id string")
    kept = winnowing.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {tuple(r) for r in kept.collect()} == {(2, "clean", "s"), (3, None, "s"), (None, "y", "s")}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES["op10_winnowing"](spark, folder), connect(folder), ORACLES["op10_winnowing"]) is None


def test_rows_of_one_id_or_none_are_judged_apart(spark):
    item = " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(None, f"x {item}"), (None, "clean"), (None, None), (1, item), (1, "clean too")], "doc_id long, text string")
    kept = winnowing.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert Counter(tuple(r) for r in kept.collect()) == Counter([(None, "clean"), (None, None), (1, "clean too")])
