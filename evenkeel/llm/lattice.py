"""SentencePiece encoding and decoding with the n best segmentations over the piece lattice.

The lattice of a text has an edge for every piece at every place; a segmentation is a path and its score the sum of
its pieces' scores in the vocabulary. No piece goes from a letter to a word mark, so the lattice is a chain of words
and each different word of a slice is solved once: all edges come from a walk of the piece trie over all places
together, and the forward Viterbi scores from one sweep over places. Backward A-star search from a word's end takes
the forward score as heuristic; as that is exact, complete paths leave the queue best first.

For the n best of a text it is enough to search the n - 1 words whose second best path loses least: leaving the best
path elsewhere is never better than leaving it in one of those.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenkeel.llm.arrays import ranges, text_slices, worker_cache
from evenkeel.llm.transducer import MARK, Vocabulary, _hash_stretches, _points

#: Added to the lowest sound score for a character outside the vocabulary, which becomes its bytes.
UNKNOWN_PENALTY = -10.0
#: Bytes of text whose lattices are in memory at once; a lattice takes some hundred times its text.
SLICE_BYTES = 768 << 10


class Lattice:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        trie: list[dict[str, int]] = [{}]
        ends = [-1]
        for piece, i in self.vocabulary.pieces.items():
            node = 0
            for c in piece:
                if c not in trie[node]:
                    trie[node][c] = len(trie)
                    trie.append({})
                    ends.append(-1)
                node = trie[node][c]
            ends[node] = i
        steps = sorted((node << 21 | ord(c), child) for node, out in enumerate(trie) for c, child in out.items())
        self.keys, self.children = np.array([s[0] for s in steps]), np.array([s[1] for s in steps])
        self.ends = np.array(ends)
        size = max([*self.vocabulary.pieces.values(), *self.vocabulary.byte_ids.values()]) + 1
        self.scores = np.zeros(size)
        for i, score in self.vocabulary.scores.items():
            self.scores[i] = score
        self.unknown = min(s for s in self.vocabulary.scores.values() if s > -1e8) + UNKNOWN_PENALTY
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in self.vocabulary.letters]] = True
        self.bytes_of = [b""] * size
        for piece, i in self.vocabulary.pieces.items():
            self.bytes_of[i] = piece.replace(MARK, " ").encode()
        for byte, i in self.vocabulary.byte_ids.items():
            self.bytes_of[i] = bytes([byte])
        self.byte_lengths = np.array([len(b) for b in self.bytes_of])
        self.byte_starts = np.append(0, np.cumsum(self.byte_lengths))[:-1]
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def words(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ranked: bool = True) -> Words:
        return Words(self, points, starts, lengths, ranked)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a text's ids: pieces and bytes put together, without the blank that encoding adds."""
        at = ranges(self.byte_starts[ids], self.byte_lengths[ids])
        return self.all_bytes[at].tobytes()[1:] if len(ids) else b""


class Words:
    """Lattices of many different words; node ``heads[k] + p`` stands before the p-th character of word k.

    ``ranked=False`` keeps the best paths alone and leaves out what a search for further ones needs.
    """

    def __init__(self, lattice: Lattice, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ranked: bool = True):
        self.lengths = lengths
        self.heads = np.cumsum(lengths + 1) - lengths - 1
        nodes = int((lengths + 1).sum())
        place = ranges(starts, lengths)
        node = ranges(self.heads, lengths)
        known = lattice.known[points[place]]
        src, dst, piece = [node[~known]], [node[~known] + 1], [np.full(int((~known).sum()), -1)]
        room = np.repeat(lengths, lengths) - (node - np.repeat(self.heads, lengths))
        lane, at, depth = np.flatnonzero(known), np.zeros(int(known.sum()), np.int64), 0
        while len(lane):
            key = at << 21 | points[place[lane] + depth]
            where = np.minimum(np.searchsorted(lattice.keys, key), len(lattice.keys) - 1)
            hit = lattice.keys[where] == key
            lane, at, depth = lane[hit], lattice.children[where[hit]], depth + 1
            whole = lattice.ends[at] >= 0
            src.append(node[lane[whole]])
            dst.append(node[lane[whole]] + depth)
            piece.append(lattice.ends[at[whole]])
            goes_on = room[lane] > depth
            lane, at = lane[goes_on], at[goes_on]
        src, dst, piece = (np.concatenate(x) for x in (src, dst, piece))
        word = np.searchsorted(self.heads, src, "right") - 1
        order = np.lexsort((src, dst, dst - self.heads[word]))
        self.src, self.dst, self.piece, self.word = src[order], dst[order], piece[order], word[order]
        self.score = np.where(self.piece >= 0, lattice.scores[self.piece], lattice.unknown)
        self.forward = np.full(nodes, -np.inf)
        self.forward[self.heads] = 0.0
        back = np.full(nodes, -1)
        for lo, hi in self._sweeps(self.dst - self.heads[self.word]):
            found = self.forward[self.src[lo:hi]] + self.score[lo:hi]
            runs = np.flatnonzero(np.append(True, np.diff(self.dst[lo:hi]) != 0))
            best = np.maximum.reduceat(found, runs)
            target = self.dst[lo:hi][runs]
            self.forward[target] = best
            ties = np.flatnonzero(found == np.repeat(best, np.diff(np.append(runs, hi - lo))))
            first = ties[np.append(True, np.diff(self.dst[lo:hi][ties]) != 0)]
            back[target] = lo + first
        self.best = self.forward[self.heads + lengths]
        taken, now = np.zeros(len(self.src), bool), self.heads + lengths
        while len(now):
            edge = back[now]
            edge = edge[edge >= 0]
            taken[edge] = True
            now = self.src[edge]
        path = np.flatnonzero(taken)
        path = path[np.lexsort((self.src[path], self.word[path]))]
        self.path = path
        self.path_of = np.searchsorted(self.word[path], np.arange(len(lengths) + 1))
        if ranked:
            self._prepare_ranking(taken)

    def _prepare_ranking(self, taken: np.ndarray) -> None:
        """What a word loses at least by leaving its best path, and the edges into each node."""
        nodes, lengths = len(self.forward), self.lengths
        # forward scores from the other side, for the best path through each edge
        self.backward = np.full(nodes, -np.inf)
        self.backward[self.heads + lengths] = 0.0
        turned = np.lexsort((self.src, -(self.src - self.heads[self.word])))
        for lo, hi in self._sweeps(-(self.src - self.heads[self.word])[turned]):
            edge = turned[lo:hi]
            found = self.backward[self.dst[edge]] + self.score[edge]
            runs = np.flatnonzero(np.append(True, np.diff(self.src[edge]) != 0))
            self.backward[self.src[edge][runs]] = np.maximum.reduceat(found, runs)
        self.loss = np.full(len(lengths), np.inf)
        through = np.where(taken, -np.inf, self.forward[self.src] + self.score + self.backward[self.dst])
        by_word = np.argsort(self.word, kind="stable")
        runs = np.flatnonzero(np.append(True, np.diff(self.word[by_word]) != 0)) if len(by_word) else by_word
        if len(runs):
            self.loss[self.word[by_word][runs]] = self.best[self.word[by_word][runs]] - np.maximum.reduceat(through[by_word], runs)
        by_dst = np.argsort(self.dst, kind="stable")
        self.into, self.into_of = by_dst, np.searchsorted(self.dst[by_dst], np.arange(nodes + 1))

    @staticmethod
    def _sweeps(level: np.ndarray) -> Iterator[tuple[int, int]]:
        edges = np.append(np.flatnonzero(np.append(True, np.diff(level) != 0)), len(level)) if len(level) else [0]
        yield from zip(edges[:-1], edges[1:], strict=True)

    def ranked(self, word: int) -> Iterator[tuple[float, list[int]]]:
        """(score, edges) of the paths of a word, best first: A-star from its end under the forward scores.

        Equal scores come in the order in which they are met, the longest last piece first.
        """
        head, end = self.heads[word], self.heads[word] + self.lengths[word]
        queue: list[tuple] = [(-self.forward[end], 0, 0.0, int(end), None)]
        met = 1
        while queue:
            _, _, behind, node, tail = heapq.heappop(queue)
            if node == head:
                path = []
                while tail is not None:
                    path.append(tail[0])
                    tail = tail[1]
                yield behind, path
                continue
            for edge in self.into[self.into_of[node] : self.into_of[node + 1]]:
                total = behind + self.score[edge]
                heapq.heappush(queue, (-(total + self.forward[self.src[edge]]), met, total, int(self.src[edge]), (int(edge), tail)))
                met += 1


def _sums(choices: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n largest sums of one value of each falling list, with the place taken in each."""
    first = (0,) * len(choices)
    queue, seen, out = [(-sum(c[0] for c in choices), first)], {first}, []
    while queue and len(out) < n:
        total, at = heapq.heappop(queue)
        out.append((-total, at))
        for k in range(len(choices)):
            if at[k] + 1 < len(choices[k]):
                moved = (*at[:k], at[k] + 1, *at[k + 1 :])
                if moved not in seen:
                    seen.add(moved)
                    heapq.heappush(queue, (total + choices[k][at[k]] - choices[k][at[k] + 1], moved))
    return out


def encode_slice(lattice: Lattice, data: np.ndarray, offsets: np.ndarray, n_best: int):
    """(ids of all texts, where each text's begin, its score, its n best: (score, changes)) of a slice.

    A change is (first id, end id, ids put there), counted in the ids of the best path.
    """
    points, edges = _points(data, offsets)
    texts = len(offsets) - 1
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(texts + 1, np.int64), np.zeros(texts), [[(0.0, [])]] * texts
    known, mark = lattice.known[points], points == ord(MARK)
    before_known, before_mark = np.append(False, known[:-1]), np.append(False, mark[:-1])
    head = ~known | ~before_known | (mark & ~before_mark)
    head[edges[:-1][edges[:-1] < len(points)]] = True
    starts = np.flatnonzero(head)
    lengths = np.diff(np.append(starts, len(points)))
    _, pick, word = np.unique(_hash_stretches(points, starts, lengths), return_index=True, return_inverse=True)
    words = lattice.words(points, starts[pick], lengths[pick], n_best > 1)
    letter = points[starts[pick]]

    def ids_of(path: np.ndarray, k: int) -> list[int]:
        if not lattice.known[letter[k]]:
            return [lattice.vocabulary.byte_ids[b] for b in chr(letter[k]).encode()]
        return [int(i) for i in words.piece[path]]

    pieces = words.piece[words.path]
    sizes = np.diff(words.path_of)
    strange = np.flatnonzero(~lattice.known[letter])
    if len(strange):
        spelled = [ids_of(None, k) for k in strange]
        times = np.ones(len(pieces), np.int64)
        at = words.path_of[strange]
        times[at] = sizes[strange] = [len(ids) for ids in spelled]
        pieces = np.repeat(pieces, times)
        pieces[ranges((np.cumsum(times) - times)[at], times[at])] = np.concatenate(spelled)
    firsts = np.cumsum(sizes) - sizes
    ids = pieces[ranges(firsts[word], sizes[word])]
    token_heads = np.append(0, np.cumsum(sizes[word]))
    word_edges = np.searchsorted(starts, edges)
    sums = np.append(0.0, np.cumsum(words.best[word]))
    score = sums[word_edges[1:]] - sums[word_edges[:-1]]
    if n_best == 1:
        return ids, token_heads[word_edges], score, [[(float(x), [])] for x in score]
    loss = words.loss[word]
    searched: dict[int, list] = {}
    best = []
    for t in range(texts):
        lo, hi = word_edges[t], word_edges[t + 1]
        near = lo + np.argsort(loss[lo:hi], kind="stable")[: n_best - 1] if hi - lo <= 64 else lo + _few_smallest(loss[lo:hi], n_best - 1)
        near = [int(x) for x in near if loss[x] < np.inf]
        for x in near:
            if word[x] not in searched:
                searched[word[x]] = list(islice(words.ranked(word[x]), n_best))
        found = []
        for lost, at in _sums([[p[0] - words.best[word[x]] for p in searched[word[x]]] for x in near], n_best):
            changes = [
                (int(token_heads[x] - token_heads[lo]), int(token_heads[x + 1] - token_heads[lo]), ids_of(searched[word[x]][k][1], word[x]))
                for x, k in zip(near, at, strict=True) if k
            ]
            found.append((float(score[t] + lost), changes))
        best.append(found)
    return ids, token_heads[word_edges], score, best


def _few_smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the n smallest values, the first of equals first."""
    if n <= 0:
        return np.zeros(0, np.int64)
    limit = np.partition(values, n - 1)[n - 1]
    some = np.flatnonzero(values <= limit)
    return some[np.argsort(values[some], kind="stable")[:n]]


def lattice_for(path: str) -> Lattice:
    cache = worker_cache()
    if cache.get("lattice_path") != path:
        cache["lattice"], cache["lattice_path"] = Lattice(path), path
    return cache["lattice"]


_BEST = "array<struct<score:double,changes:array<struct<first:int,end:int,ids:array<int>>>>>"


def encode(documents: DataFrame, path: str, n_best: int = 3, keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_pieces, score, ids, ids_sha256, restored, n_best) of each row of ``documents`` (doc_id, text).

    ids is the best segmentation and score its score; ids_sha256 digests the ids as little-endian 32-bit numbers;
    restored says that decoding gives the text back, in which the word mark reads as a blank. n_best holds up to
    ``n_best`` segmentations, best first, each as its score and the changes to ids that make it. NULL and
    empty texts have no pieces and one segmentation of score 0. Rows are encoded one by one, so NULL and repeated
    ids keep their rows; other columns are left out. ``keep_ids=False`` leaves ids out.
    """
    best_type = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_for(path)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                ids, heads, score, best = encode_slice(lattice, data, offsets, n_best)
                flat = ids.astype("<i4")
                digests, restored = [], []
                for t in range(end - first):
                    own = flat[heads[t] : heads[t + 1]]
                    digests.append(hashlib.sha256(own.tobytes()).hexdigest())
                    text = data[offsets[t] : offsets[t + 1]].tobytes()
                    restored.append(lattice.decode(own) == text.replace(MARK.encode(), b" "))
                columns = {
                    "doc_id": batch.column(0)[first:end], "n_pieces": pa.array(np.diff(heads)), "score": pa.array(score),
                    "ids_sha256": pa.array(digests, pa.string()), "restored": pa.array(restored, pa.bool_()),
                    "n_best": pa.array([[{"score": s, "changes": [{"first": a, "end": b, "ids": i} for a, b, i in c]} for s, c in found] for found in best], best_type),
                }
                if keep_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(heads.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_pydict(columns)

    fields = f"doc_id long, n_pieces long, score double, ids_sha256 string, restored boolean, n_best {_BEST}"
    return documents.select("doc_id", "text").mapInArrow(encoded, fields + (", ids array<int>" if keep_ids else ""))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of ``encoded`` (doc_id, ids); NULL ids give a NULL text, bytes that are no UTF-8 replacement marks."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_for(path)
        for batch in batches:
            texts = [
                lattice.decode(np.asarray(ids.values, np.int64)).decode(errors="replace") if ids.is_valid else None for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")
