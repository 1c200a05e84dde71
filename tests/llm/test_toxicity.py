"""Held-out accuracy on the given labels, and folding, exceptions and edge cases."""

import random

import pytest

from evenkeel.llm import toxicity
from evenkeel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = QUERIES["op6_toxicity"](spark, FOLDER).collect()
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    out = [(labels[r.doc_id], r.predicted, r.score) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, p, s in out)
    assert sum(a == p for a, p, _ in out) / len(out) >= 0.93


def test_folding():
    table = toxicity._Folding()
    assert toxicity.fold("1D10T! scυм\tｓｃｕｍ Ångström $tup1d", table) == " idiot scum scum ångström stupid "
    assert toxicity.fold("", table) == "  " or toxicity.fold("", table).strip() == ""


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    filler = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re") for b in ("n", "l", "rs", "t")]
    rows, labels = [], []
    for i in range(400):
        words, toxic = rng.choices(filler, k=30), int(i % 4 == 0)
        if toxic:
            words[rng.randrange(30)] = rng.choice(["vilest", "zwoobar", "zwooqux", "zwoomel"])
        elif i % 40 == 1:
            words[5:7] = ["vilest", "creature"]
        rows.append((i, " ".join(words), i))
        labels.append((i, toxic, 1))
    labels += [(3, None, 0), (None, 1, 0)]
    return toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, label int"), spark.createDataFrame(labels, "doc_id long, toxic int, text int"))


def test_lexicon_beginnings_exceptions_and_scores(spark, model):
    assert any("zwoomega".startswith(t) for t in model["lexicon"]) and "vilest creature" in model["exceptions"]
    rows = [(1, "bat kon ZW00mega mil", 1), (1, "bat kon ZW00mega mil", 1), (2, "the vilest creature", 1), (3, None, 1), (None, "", 1), (4, "you are vilest", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = sorted(((r.doc_id, r.predicted) for r in toxicity.score(frame, model).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (2, 0), (3, 0), (None, 0), (4, 1)], key=str)
    assert {r.doc_id for r in toxicity.reject(frame, model).collect()} == {2, 3, None}
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0]
