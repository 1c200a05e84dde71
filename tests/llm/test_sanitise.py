"""Known forms against Python's pattern search, disclosures against counts by hand."""

import hashlib
import math
import random
import re
from collections import Counter

from evenkeel.llm import sanitise
from evenkeel.llm.queries import QUERIES


def luhn(value):
    digits = [int(c) for c in value if c in "0123456789"][::-1]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def n_digits(value):
    return sum(c in "0123456789" for c in value)


def base(text):
    text = text or ""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= n_digits(m[0]) <= 19 and luhn(m[0])]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= n_digits(m[0]) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def texts():
    rng = random.Random(6)
    bits = ["a@b.c", "x.y@mail-1.org", "_d@e.f", "@", ".", "10.0.0.1", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "411111111111111", "+1 (555) 010-9999", "+49.30.123456",
            "+", "-", " ", "  ", "é", "word", "0", "7", "12", "\n", "00000000000000", "+1", "000.000.000.0001", "\U0001f600"]
    fixed = [None, "", "plain", "a" * 50000, "1" * 50000, "1 " * 20000, "a.b@" * 3000, "+1" * 2000, "1." * 5000, "x@y" + ".z" * 4000, "4111 1111 1111 1111" + " 4111 1111 1111 1111" * 3]
    return fixed + ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(300)]


def test_base_spans(spark, tmp_path):
    rows = [(i if i % 9 else None, t, 1) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, entities int")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op9_personal_data"](spark, str(tmp_path)).collect()
    got = Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found)
    want = Counter()
    for i, t, _ in rows:
        b = base(t)
        want[(i, hashlib.sha256(b.encode()).hexdigest(), *(sum(x.startswith(k) for x in b.split(",")) for k in sanitise.KINDS))] += 1
        assert any(r.doc_id == i and r.spans.startswith(b) for r in found)
    assert got == want


def test_disclosing_terms(spark):
    rows = [(i, f"filler number {'abcdefghij'[i % 10]} goes here", 0) for i in range(60)]
    rows += [(100, "Captain Zorblax wrote from ahab@sea.org today", 0), (101, "ask Zorblax at AHAB@sea.org about it today", 0), (102, "today we rest", 0)]
    rows += [(103, None, 0), (None, "Zorblax, ahab@sea.org", 0), (100, "Captain Zorblax wrote from ahab@sea.org today", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, terms int")
    out = {(r.doc_id, r.text) for r in sanitise.sanitise(frame).collect()}
    assert (101, "ask  at [EMAIL] about it today") in out and (None, ", [EMAIL]") in out and (103, "") in out and (102, "today we rest") in out
    assert len(sanitise.sanitise(frame).collect()) == len(rows)
    assert sanitise.personal_data(frame.limit(0)).count() == 0


def test_terms_anywhere_in_texts_and_for_what_repeats_in_entities(spark):
    far = "and so on " * 20
    rows = [(i, f"filler and so on number {'abcdefghij'[i % 10]} goes here", 0) for i in range(200)]
    # no address occurs twice; the domain and the term do, 200 code points apart and on both sides
    rows += [(300 + i, f"Quendor {far}mail u{i}@quend.example {far}quendor here", 0) for i in range(4)]
    rows += [(400, f"one Vexley in a single text {far}call +49 30 5550 1234", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, terms int")
    found = {r.doc_id: r for r in sanitise.personal_data(frame).collect()}
    for i in range(4):
        text = rows[200 + i][1]
        marked = {text[t.start : t.end].lower(): t.disclosure for t in found[300 + i].terms}
        assert [text[t.start : t.end] for t in found[300 + i].terms if t.disclosure >= sanitise.REMOVE].count("Quendor") == 1
        assert marked["quendor"] >= sanitise.REMOVE and "and" not in marked and "here" not in marked
    text = rows[204][1]
    alone = {text[t.start : t.end]: t.disclosure for t in found[400].terms}
    n, chance = 205, 0.75  # a pair of one text: log2(205 * 0.75) / log2(205)
    assert abs(alone["Vexley"] - math.log2(n * chance) / math.log2(n)) < 1e-9
    assert all(not r.terms for d, r in found.items() if d < 300)
