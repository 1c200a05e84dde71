"""Each stage on its own input, and the whole run."""

import corpus_pipeline
import pytest
import sentencepiece
from test_jaccard import shingles
from test_winnowing import words

from evenkeel.llm.queries import tokenizer_path
from evenkeel.llm.tables import given

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """The written input and output of every stage."""
    docs, out = given(spark, FOLDER, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"stage{k}") / "out")
        stage(spark, docs, FOLDER).write.parquet(path)
        kept = spark.read.parquet(path)
        out.append((name, docs, kept))
        docs = kept
    return out


def test_columns_and_ids(outputs):
    for name, before, after in outputs[:-1]:
        assert after.columns == before.columns, name
        assert after.exceptAll(before).count() == 0 or name == "line dedup"
        assert 0 < after.count() <= before.count()


def test_one_of_each_group(outputs):
    _, before, after = outputs[2]
    kept = {r.doc_id: shingles(r.text) for r in after.collect()}
    for a in kept:
        for b in kept:
            both = len(kept[a] & kept[b])
            assert a >= b or not both or 100 * both < 75 * len(kept[a] | kept[b])
    assert {r.doc_id for r in before.collect() if not shingles(r.text)} <= set(kept)


def test_decontaminated(spark, outputs):
    _, before, after = outputs[3]
    windows = {tuple(w[i : i + 10]) for r in given(spark, FOLDER, "benchmark").collect() for w in [words(r.text)] for i in range(max(1, len(w) - 9))}
    clean = {r.doc_id for r in before.collect() for w in [words(r.text)] if not any(tuple(w[i : i + 10]) in windows for i in range(max(1, len(w) - 9)))}
    assert {r.doc_id for r in after.collect()} == clean


def test_pieces(outputs):
    _, before, after = outputs[4]
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.restored for r in rows)
    assert all(library.decode(list(r.ids)) == texts[r.doc_id] for r in rows)


def test_pieces_ranks_further_segmentations(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, ""), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in corpus_pipeline.pieces(spark, docs, FOLDER).collect()}
    assert [len(rows[i].n_best) for i in (1, 2, 3)] == [3, 1, 1]
    scores = [b.score for b in rows[1].n_best]
    assert scores == sorted(scores, reverse=True) and abs(scores[0] - rows[1].score) < 1e-6 and not rows[1].n_best[0].changes
    library, seen = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path()), set()
    for b in rows[1].n_best:
        ids = list(rows[1].ids)
        for c in sorted(b.changes, key=lambda c: -c.first):
            ids[c.first : c.end] = c.ids
        seen.add(tuple(ids))
        assert library.decode(ids) == "the cat sat on the mat"
    assert len(seen) == 3


def test_run(spark, outputs):
    assert corpus_pipeline.run(spark, FOLDER).count() == outputs[-1][2].count()
