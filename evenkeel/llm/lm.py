"""An interpolated modified Kneser-Ney bigram model, counted in Spark and read through memory-mapped arrays.

Counting. Each task folds its texts to distinct (word, next word) pairs and deals them, packed, to buckets by the
hash of the first word. A bucket adds them up, writes its pairs and its contexts as sorted hash arrays, and deals
the distinct next words to buckets by their hash, which count left contexts and write those. Words and pairs are
64-bit hashes. Frequent words and copied texts are folded in the task before anything moves.

Scoring. Workers map the arrays and look up each distinct word and pair of a slice of texts by binary search.
Pages are shared by the workers of a machine and dropped under pressure, so memory does not follow the model.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.arrays import joined_hash, packed, text_slices, unpacked, words_of, worker_cache
from evenkeel.session import fresh_path

#: Buckets of the model; each is counted by one task and is one set of arrays.
BUCKETS = 64
#: Pairs that a task gathers before it deals them out.
HELD_PAIRS = 3_000_000
START, END = np.uint64(1), np.uint64(2)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words, next words, pairs before each text): each text is START, its words, END."""
    hashes, counts = words_of(data, offsets)
    texts = len(counts) - 1
    flat = np.empty(len(hashes) + 2 * texts, np.uint64)
    heads = counts[:-1] + 2 * np.arange(texts)
    ends = counts[1:] + 2 * np.arange(texts) + 1
    inner = np.ones(len(flat), bool)
    inner[heads] = inner[ends] = False
    flat[heads], flat[ends], flat[inner] = START, END, hashes
    first = np.ones(len(flat), bool)
    first[ends] = False
    then = np.ones(len(flat), bool)
    then[heads] = False
    return flat[first], flat[then], counts + np.arange(texts + 1)


def _folded(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in the order of their hash: (pair hash, first, next, count)."""
    key = joined_hash(v, w)
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(c[order], heads) if len(key) else c
    at = order[heads]
    return key[heads], v[at], w[at], total


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in ``keys``) with the places in rising order of the key."""
    bucket = _bucket(keys, buckets)
    order = np.lexsort((keys, bucket))
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(heads, lengths) of the runs of equal neighbours."""
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return heads, np.diff(np.append(heads, len(values)))


def _file_system(uri: str):
    """(file system, path in it) of a folder that Spark shares."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _store(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays into a folder; a repeated task writes the same again and moves it into place."""
    store, folder = _file_system(uri)
    store.create_dir(folder, recursive=True)
    for name, values in arrays.items():
        passing = f"{folder}/{name}.{uuid.uuid4().hex}"
        with store.open_output_stream(passing) as out:
            out.write(pa.py_buffer(np.ascontiguousarray(values).tobytes()))
        store.move(passing, f"{folder}/{name}")


def _mapped(uri: str, name: str, kind) -> np.ndarray:
    """An array of the folder, memory-mapped; one in a remote store is copied to a local file that has no name."""
    from pyarrow import fs

    store, folder = _file_system(uri)
    path = f"{folder}/{name}"
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound or not info.size:
        return np.zeros(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.asarray(np.memmap(path, kind, "r"))
    with tempfile.TemporaryFile() as local, store.open_input_stream(path) as source:
        while block := source.read(8 << 20):
            local.write(block)
        local.flush()
        return np.asarray(np.memmap(local, kind, "r"))


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _discounts(n: list[int]) -> np.ndarray:
    """What modified Kneser-Ney takes off counts of 0, 1, 2, and 3 or more; a half where counts of counts are missing."""
    if min(n[:3]) <= 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))])


PAIR_ROWS = "bucket int, v binary, repeats binary, w binary, c binary"
NEXT_ROWS = "bucket int, w binary, c binary, n1 long, n2 long, n3 long, n4 long, tokens long, texts long"
STATS = "n1 long, n2 long, n3 long, n4 long, tokens long, texts long, words long, left long, m1 long, m2 long, m3 long, m4 long"


def train(documents: DataFrame) -> dict:
    """Count the texts of ``documents`` (text) and store the model; returns where it is and its few totals.

    NULL counts as an empty text, which is one END token. No rows give an empty model.
    """
    buckets = max(BUCKETS, documents.rdd.getNumPartitions())
    folder = fresh_path(documents.sparkSession, "model")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            _, v, w, c = _folded(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            rows = []
            for b, at in _dealt(v, buckets):
                heads, lengths = _runs(v[at])
                rows.append((b, packed(v[at][heads]), packed(lengths.astype(np.uint32)), packed(w[at]), packed(c[at].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 4], strict=True)],
                ["bucket", "v", "repeats", "w", "c"],
            )

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                v, w, _ = _pairs(data, offsets)
                _, v, w, c = _folded(v, w, np.ones(len(v), np.int64))
                held.append((v, w, c))
                if sum(len(x[0]) for x in held) > HELD_PAIRS:
                    yield from dealt()
        if held:
            yield from dealt()

    def contexts(table: pa.Table) -> pa.Table:
        b = table["bucket"][0].as_py()
        v, _ = unpacked(table["v"], np.uint64)
        repeats, _ = unpacked(table["repeats"], np.uint32)
        w, _ = unpacked(table["w"], np.uint64)
        c, _ = unpacked(table["c"], np.uint32)
        key, v, w, c = _folded(np.repeat(v, repeats), w, c.astype(np.int64))
        order = np.argsort(v, kind="stable")
        heads, _ = _runs(v[order])
        at = c[order]
        stats = np.stack([np.add.reduceat(x.astype(np.int64), heads) for x in (at, at == 1, at == 2, at >= 3)], axis=1)
        _store(folder, {f"pairs-{b}": key, f"counts-{b}": c, f"firsts-{b}": v[order][heads], f"totals-{b}": stats})
        texts = int(c[v == START].sum())
        w = np.sort(w)
        heads, lengths = _runs(w)
        rows = [(t, packed(w[heads][x]), packed(lengths[x].astype(np.uint32)), 0, 0, 0, 0, 0, 0) for t, x in _dealt(w[heads], buckets)]
        rows.append((b, b"", b"", *_counts_of_counts(c), int(c.sum()), texts))
        kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 6]
        names = [x.split()[0] for x in NEXT_ROWS.split(", ")]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def nexts(table: pa.Table) -> pa.Table:
        b = table["bucket"][0].as_py()
        w, _ = unpacked(table["w"], np.uint64)
        c, _ = unpacked(table["c"], np.uint32)
        order = np.argsort(w)
        heads, _ = _runs(w[order])
        left = np.add.reduceat(c[order].astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
        _store(folder, {f"nexts-{b}": w[order][heads], f"lefts-{b}": left})
        passed = [sum(table[x].to_pylist()) for x in ("n1", "n2", "n3", "n4", "tokens", "texts")]
        names = [x.split()[0] for x in STATS.split(", ")]
        return pa.table([pa.array([x], pa.int64()) for x in [*passed, len(heads), int(left.sum()), *_counts_of_counts(left)]], names=names)

    counted = (
        documents.select("text").mapInArrow(pairs, PAIR_ROWS)
        .groupBy("bucket").applyInArrow(contexts, NEXT_ROWS)
        .groupBy("bucket").applyInArrow(nexts, STATS)
    )
    totals = counted.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in counted.columns]).first().asDict()
    return {"folder": folder, "buckets": buckets, **totals}


class _Reader:
    """The arrays of a model, mapped where they are first needed."""

    def __init__(self, model: dict):
        self.model, self.maps = model, {}
        self.pair_discounts = _discounts([model[x] for x in ("n1", "n2", "n3", "n4")])
        m = [model[x] for x in ("m1", "m2", "m3", "m4")]
        self.word_discounts = _discounts(m)
        rest = [m[0], m[1], model["words"] - m[0] - m[1]]
        taken = sum(d * n for d, n in zip(self.word_discounts[1:], rest, strict=True))
        self.uniform = 1.0 / (model["words"] + 1)
        self.word_back = taken / model["left"] * self.uniform if model["left"] else self.uniform

    def array(self, name: str, bucket: int, kind) -> np.ndarray:
        at = f"{name}-{bucket}"
        if at not in self.maps:
            self.maps[at] = _mapped(self.model["folder"], at, kind)
        return self.maps[at]

    def found(self, keys: np.ndarray, dealt_by: np.ndarray, names: tuple[str, str], width: int) -> np.ndarray:
        """Values of ``keys`` in the arrays of the bucket of ``dealt_by``; zeros for a key that is not there."""
        out = np.zeros((len(keys), width), np.int64)
        bucket = _bucket(dealt_by, self.model["buckets"])
        order = np.lexsort((keys, bucket))
        edges = np.searchsorted(bucket[order], np.arange(self.model["buckets"] + 1))
        for b in np.flatnonzero(np.diff(edges)):
            at = order[edges[b] : edges[b + 1]]
            there = self.array(names[0], b, np.uint64)
            if not len(there):
                continue
            place = np.minimum(np.searchsorted(there, keys[at]), len(there) - 1)
            hit = there[place] == keys[at]
            out[at[hit]] = self.array(names[1], b, np.int64).reshape(-1, width)[place[hit]]
        return out

    def word_probability(self, words: np.ndarray) -> np.ndarray:
        left = self.found(words, words, ("nexts", "lefts"), 1)[:, 0]
        kept = left - self.word_discounts[np.minimum(left, 3)]
        return (kept / self.model["left"] if self.model["left"] else 0.0) + self.word_back

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score and model score."""
        v, w, edges = _pairs(data, offsets)
        key = joined_hash(v, w)
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        words, place = np.unique(np.concatenate([v[first], w[first]]), return_inverse=True)
        v_at, w_at = place[: len(first)], place[len(first) :]
        totals = self.found(words, words, ("firsts", "totals"), 4)
        chance = self.word_probability(words)
        times = self.found(key[first], v[first], ("pairs", "counts"), 1)[:, 0]
        context = totals[v_at]
        freed = context[:, 1:] @ self.pair_discounts[1:]
        total = np.maximum(context[:, 0], 1)
        kept = times - self.pair_discounts[np.minimum(times, 3)]
        model = np.where(context[:, 0] > 0, kept / total + freed / total * chance[w_at], chance[w_at])
        seen = totals[:, 0].copy()
        seen[words == END] = self.model["texts"]
        seen[words == START] = 0
        base = np.log10((seen[w_at] + 0.5) / (self.model["tokens"] + 0.5 * (self.model["words"] + 1)))
        per_text = lambda x: np.add.reduceat(x[back], edges[:-1])
        return np.diff(edges), per_text((seen[w_at] > 0).astype(np.int64)), per_text(base), per_text(np.log10(model))


def score(documents: DataFrame, model: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) for each row of ``documents`` (doc_id, text).

    Scores are sums of log10 probabilities over the words and END; NULL counts as empty. Rows are scored one by
    one, so repeated and NULL ids keep their rows. Other columns are left out.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        if cache.get("lm_folder") != model["folder"]:
            cache["lm_folder"], cache["lm_reader"] = model["folder"], _Reader(model)
        reader = cache["lm_reader"]
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                n, known, base, found = reader.scores(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:end], *(pa.array(x) for x in (n, known, base, found, 10 ** (-found / n)))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        scored, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )

