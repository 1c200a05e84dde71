"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers letters, turns look-alikes of other scripts and digit substitutions into the letters they stand for,
and everything that is no letter into blanks. The lexicon is learned from labelled rows: words, and beginnings of
words, whose documents are toxic far more often than others, weighted by their log odds. Phrases of two words in
which an entry is harmless in those rows are exceptions, whose entries do not count. The weights found in a text,
divided by its length, go through a logistic curve fitted on the same rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.tables import written

#: Labelled rows that the model is fitted on at most, taken in a hashed order of their ids.
TRAINING_ROWS = 20_000
#: Entries looked at, entries kept, least toxic documents of an entry, least log odds, shortest beginning of a word.
CANDIDATES, LEXICON, LEAST_DOCUMENTS, LEAST_WEIGHT, SHORTEST = 20_000, 2_000, 5, 2.0, 3
#: A phrase is an exception from so many harmless documents on, at no more than this share of toxic ones.
EXCEPTION_DOCUMENTS, EXCEPTION_SHARE = 3, 0.2

#: Letters of other scripts and digits with the letter they look like.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}


class _Folding(dict):
    """Code point to what it folds to, filled as code points are met."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        if 0xFF01 <= point <= 0xFF5E:
            c = chr(point - 0xFEE0)
        low = c.lower()
        found = LOOK_ALIKES.get(low, low if low.isalpha() else " ")
        self[point] = found
        return found


def fold(text: str, table: _Folding) -> str:
    """Folded words, each with one blank before it, and one at the end."""
    return " " + " ".join(text.translate(table).split()) + " "


def _terms(words: set[str]) -> set[str]:
    """Whole words (ending in a blank) and their beginnings."""
    return {w + " " for w in words} | {w[:n] for w in words for n in range(SHORTEST, min(len(w), 12) + 1)}


def _counted_terms(wanted: frozenset | None):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = _Folding(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = _terms(set(fold(text or "", table).split()))
                seen.update(terms if wanted is None else terms & wanted)
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    return counted


class Matcher:
    """Finds the entries of a lexicon in folded text."""

    def __init__(self, lexicon: dict[str, float], exceptions: frozenset):
        import ahocorasick

        self.exceptions, self.automaton = exceptions, ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(" " + term, (len(term.rstrip()), term.endswith(" "), weight))
        if lexicon:
            self.automaton.make_automaton()
        self.some = bool(lexicon)

    def hits(self, folded: str) -> Iterator[tuple[float, str, str]]:
        """(weight, phrase with the word before, phrase with the word after) of each matched word, its best entry."""
        best: dict[int, float] = {}
        for end, (length, whole, weight) in self.automaton.iter(folded) if self.some else ():
            start = end - length + (0 if whole else 1)
            if weight > best.get(start, 0.0):
                best[start] = weight
        for start, weight in best.items():
            stop = folded.index(" ", start)
            before = folded.rfind(" ", 0, start - 1) + 1 if start > 1 else start
            after = folded.find(" ", stop + 1)
            yield weight, folded[before:stop], folded[start : after if after > 0 else stop]

    def rate(self, folded: str) -> float:
        """Weight per thousand words, on a log scale."""
        total = sum(w for w, a, b in self.hits(folded) if a not in self.exceptions and b not in self.exceptions)
        return math.log1p(1000.0 * total / max(folded.count(" ") - 1, 1))


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, lightly held towards zero."""
    design, theta = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    hold = np.diag([1e-3, 1e-2])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (y - p) - hold @ theta
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + hold, gradient)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> dict:
    """Fit the model on ``labels`` (doc_id, toxic) and the texts of ``documents`` (doc_id, text).

    NULL labels and ids do not count; an id labelled twice is toxic if one label says so; of ids with several texts
    each is a row. At most ``rows`` labels are used. Without rows of both kinds the lexicon is empty and every text
    gets the share of toxic rows.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "label_id")
    # at most ``rows`` pairs of numbers
    texts = documents.select("doc_id", "text")
    joined = texts.join(F.broadcast(sample), texts["doc_id"] == sample["label_id"]).select("text", "label")
    texts = written(joined, "labelled")
    toxic, clean = texts.where("label = 1").select("text"), texts.where("label <> 1").select("text")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        share = n_toxic / max(n_toxic + n_clean, 1)
        return {"lexicon": {}, "exceptions": frozenset(), "curve": (math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0)}
    count = lambda df, wanted: df.mapInArrow(_counted_terms(wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    often = count(toxic, None).where(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "term").limit(CANDIDATES)
    in_toxic = {r.term: r.n for r in often.collect()}
    in_clean = {r.term: r.n for r in count(clean, frozenset(in_toxic)).collect()}

    def weight(term: str) -> float:
        t, c = in_toxic[term], in_clean.get(term, 0)
        return math.log((t + 0.5) / (n_toxic - t + 0.5)) - math.log((c + 0.5) / (n_clean - c + 0.5))

    weights = {t: w for t in in_toxic if (w := weight(t)) >= LEAST_WEIGHT}
    lexicon: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        shorter = [lexicon[term[:n]] for n in range(SHORTEST, len(term)) if term[:n] in lexicon]
        if not shorter or weights[term] > max(shorter) + 0.5:
            lexicon[term] = weights[term]
    lexicon = dict(sorted(lexicon.items(), key=lambda x: (-x[1], x[0]))[:LEXICON])

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, matcher, seen = _Folding(), Matcher(lexicon, frozenset()), {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[int(label == 1)].update({p for _, a, b in matcher.hits(fold(text or "", table)) for p in (a, b) if " " in p})
        for kind, found in seen.items():
            yield pa.RecordBatch.from_pydict(
                {"phrase": pa.array(list(found), pa.string()), "kind": pa.array([kind] * len(found), pa.int32()), "n": pa.array(list(found.values()), pa.int64())}
            )

    bad, good = F.sum(F.col("n") * F.col("kind")), F.sum(F.col("n") * (1 - F.col("kind")))
    harmless = (
        texts.mapInArrow(phrases, "phrase string, kind int, n long").groupBy("phrase").agg(bad.alias("bad"), good.alias("good"))
        .where((F.col("good") >= EXCEPTION_DOCUMENTS) & (F.col("bad") <= EXCEPTION_SHARE * (F.col("bad") + F.col("good"))))
        .orderBy(F.desc("good"), "phrase").limit(LEXICON)
    )
    exceptions = frozenset(r.phrase for r in harmless.collect())

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, matcher = _Folding(), Matcher(lexicon, exceptions)
        for batch in batches:
            rates = [matcher.rate(fold(t or "", table)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rates, pa.float64()), batch.column(1).cast(pa.int32())], ["x", "y"])

    points = texts.mapInArrow(rated, "x double, y int").toPandas().sort_values(["x", "y"])
    return {"lexicon": lexicon, "exceptions": exceptions, "curve": _fitted(points["x"].to_numpy(), (points["y"] == 1).to_numpy(float))}


def score(documents: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, predicted) of each row of ``documents`` (doc_id, text): how likely it is toxic.

    NULL counts as empty; only the text is read. Rows are scored one by one, so NULL and repeated ids keep their
    rows; other columns are left out.
    """
    lexicon, exceptions, (intercept, slope) = model["lexicon"], model["exceptions"], model["curve"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, matcher = _Folding(), Matcher(lexicon, exceptions)
        for batch in batches:
            rates = np.array([matcher.rate(fold(t.as_py() or "", table)) for t in batch.column(1)], float)
            found = 1 / (1 + np.exp(-np.clip(intercept + slope * rates, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    found = documents.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(documents: DataFrame, model: dict) -> DataFrame:
    """The rows of ``documents``, all columns, that are not predicted toxic."""
    lexicon, exceptions, (intercept, slope) = model["lexicon"], model["exceptions"], model["curve"]
    place = documents.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, matcher = _Folding(), Matcher(lexicon, exceptions)
        for batch in batches:
            rates = np.array([matcher.rate(fold(t.as_py() or "", table)) for t in batch.column(place)], float)
            yield batch.filter(pa.array(intercept + slope * rates < 0))

    return documents.mapInArrow(kept, documents.schema)
