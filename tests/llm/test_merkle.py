"""Merkle trees of texts against a plain-Python tree, and where edits are found."""

import hashlib
import random
import re

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from evenkeel.llm import merkle
from evenkeel.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, tree string, _tie int, lang string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(text):
    paragraphs = [sha(p) for p in text.split("\n")]
    sections, run = [], []
    for p in paragraphs:
        run.append(p)
        if p[0] in "08" or p == sha(""):
            sections.append(" ".join(run))
            run = []
    if run:
        sections.append(" ".join(run) + " ")
    sections = [sha(s) for s in sections]
    phrases = re.sub("([^a-gi-np-su-y]) ", "\\1 \n", text).split("\n")
    root = sha(" ".join(sections))
    nodes = {("r", root), *(("s", x) for x in sections), *(("p", x) for x in paragraphs), *(("l", x) for x in phrases)}
    return root, len(sections), len(paragraphs), nodes


def alike(a, b):
    return 2 * len(a[3] & b[3]) / (len(a[3]) + len(b[3]))


def expected(rows):
    rows = [(i, t or "") for i, t, *_ in rows]
    ranked = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for at, (i, text) in enumerate(ranked):
        other = ranked[(at + 1) % len(ranked)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        own, later, after = plain_tree(text), plain_tree(edited), plain_tree(other)
        out.append((i, len(text), sha(edited), own[0], later[0], alike(own, later), alike(own, after), own[1], own[2]))
    return sorted(out, key=str)


def found(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r)[:9] for r in QUERIES["op11_fingerprints"](spark, str(tmp_path)).collect()), key=str)


def texts(n, seed):
    draw = random.Random(seed)
    words = ["wo", "that", "één", "x.", "Ünder", "鯨", "mostly", "\U0001f600", ""]
    return [("\n" if draw.random() < 0.5 else " ").join(draw.choice(words) for _ in range(draw.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("chunk_bytes", [60, 1 << 20])
def test_against_a_plain_tree(spark, tmp_path, monkeypatch, chunk_bytes):
    monkeypatch.setattr(merkle, "CHUNK_BYTES", chunk_bytes)
    rows = [(i * 3, t, "clash", 1, None) for i, t in enumerate(texts(60, 4))]
    rows += [(1000, "", None, None, None), (1001, None, None, None, "en"), (None, "no id\n\n\nhere", None, 2, None)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_repeated_rows_equal_texts_and_none(spark, tmp_path):
    rows = [(5, "a b\nc", None, 0, None)] * 3 + [(4, "a b\nc", None, 0, None)]
    got = found(spark, tmp_path, rows)
    assert got == expected(rows) and len({r[3] for r in got}) == 1 and {r[6] for r in got} == {1.0}
    assert found(spark, tmp_path / "none", []) == []


def test_a_very_long_text(spark, tmp_path):
    rows = [(1, "word of it \n" * 200_000 + "end", None, 0, None), (2, "x " * 300_000, None, 0, None)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_like_only_with_equal_roots(spark):
    pairs = [("a\nb", "b\na"), ("a\na", "a"), ("a", "a\n"), ("a ", "a"), ("one", "one")]
    df = spark.createDataFrame(pairs, "l string, r string")
    rows = merkle.with_tree(merkle.with_tree(df, "l", "x"), "r", "y")
    got = rows.select("l", "r", merkle.likeness(F.col("x"), F.col("y")).alias("n"), (F.col("x.root") == F.col("y.root")).alias("e")).collect()
    assert all((r.n == 1.0) == r.e == (r.l == r.r) for r in got)


def test_edits_are_located(spark):
    lines = [f"line number {i}" for i in range(200)]
    later = [*lines[:50], "new one", *lines[50:120], *lines[121:]]
    frame = lambda rows: merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    before = frame([(1, "\n".join(lines)), (2, "same\ntext"), (3, "gone"), (None, "x\ny")])
    after = frame([(1, "\n".join(later)), (2, "same\ntext"), (4, "came"), (None, "x\nz")])
    got = {(r.doc_id, r.side, r.node) for r in merkle.edits(before, after).collect()}
    assert got == {
        (1, "added", sha("new one")), (1, "removed", sha(lines[120])), (3, "removed", sha("gone")), (4, "added", sha("came")),
        (None, "removed", sha("y")), (None, "added", sha("z")),
    }
    trees = {r.doc_id: r.tree for r in before.collect()}
    for r in merkle.edits(before, after).where("doc_id = 1 and side = 'removed'").collect():
        runs, at = [], 0
        for node in trees[1].paragraphs:
            runs += [[]] if at == len(runs) else []
            runs[at].append(node)
            at += node[0] in "08" or node == sha("")
        assert runs[r.section][r.paragraph] == r.node


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES["op11_fingerprints"](spark, folder), connect(folder), ORACLES["op11_fingerprints"]) is None
