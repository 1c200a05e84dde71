"""Token counts by a compiled finite-state transducer.

A pair-merging vocabulary is local: a sequence of pieces is the tokenizer's answer exactly when each piece stands
for itself and each neighbouring pair stays apart. So after every prefix the last piece follows from earlier ones,
and the piece before. A state holds what later characters may need: for every start from which a piece may still
be running its place in the piece trie, the piece that ends there, and how many fewer tokens that prefix had. A
transition reads one character and carries the number of tokens emitted, which may be negative when pieces join.
States are made when first met and kept in a dense table, through which all different words of a slice step together.

Words enter in the start state, since no piece goes on from a letter to a word mark. A very long word is cut into
chunks. The state map of a chunk takes each entry state that can occur to the exit state and the tokens emitted; maps
compose associatively, so a prefix scan over them gives every chunk's entry and the total in a logarithmic number of
steps. Entries that can occur are those the map before leads to; all chunks are run together from what a few warm-up
characters lead to, and then, again together, from entries that are still missing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.arrays import mixed, text_slices, worker_cache

MARK = "▁"
#: States and judged pairs kept from one slice to the next, which bounds a worker's memory; bytes of text in a slice.
KEPT_STATES, KEPT_PAIRS, SLICE_BYTES = 120_000, 1_500_000, 768 << 10
#: Characters with a column of their own; long words and their chunks.
COLUMNS, CHUNK, WARM_UP = 255, 2048, 96
#: Pieces below a trie place that are looked at one by one.
LISTED = 30
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces, scores and the merges they imply, read from a model file's own list."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in ids}
        self.scores = {i: model.get_score(i) for i in ids}
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.get_piece_size()) if model.is_byte(i)}
        self.unknown = model.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece runs over the start of a word")
        self.letters = {c for p in self.pieces for c in p}
        if not self.letters <= self.pieces.keys():
            raise ValueError("a letter of a piece is no piece")
        self.mark_runs = {len(p) for p in self.pieces if not p.strip(MARK)}
        self._runs: dict[int, int] = {}
        self.halves: dict[str, tuple[str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The tokenizer's pieces for letters that are all known: best pair first, the left one of equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (joined := parts[i] + parts[j]) in self.pieces:
                heapq.heappush(heap, (-self.scores[self.pieces[joined]], i, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def halves_of(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``, which is its own tokenization; None for a letter."""
        if len(piece) == 1:
            return None
        if piece not in self.halves:
            saved = self.pieces.pop(piece)
            self.halves[piece] = tuple(self.merged(piece))
            self.pieces[piece] = saved
        return self.halves[piece]

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether the two pieces next to each other stay as they are.

        Undo the younger piece's last merge again and again, so that the pieces at the border are those of an
        earlier time; the border is crossed if at some time the two could merge before the next merge that made
        either of them. Of equal scores the left merge comes first.
        """
        age = lambda p: (-self.scores[self.pieces[p]] if len(p) > 1 else float("-inf"))
        next_left = next_right = float("inf")
        while True:
            joined = self.pieces.get(left + right)
            if joined is not None:
                at = -self.scores[joined]
                if at < next_left and at <= next_right:
                    return False
            if len(left) == 1 and len(right) == 1:
                return True
            if age(left) > age(right) or (age(left) == age(right) and len(left) > 1 and len(right) == 1):
                next_left, left = age(left), self.halves_of(left)[1]
            else:
                next_right, right = age(right), self.halves_of(right)[0]

    def forget(self) -> None:
        self._runs.clear()

    def mark_tokens(self, n: int) -> int:
        """Tokens of ``n`` word marks in a row that no word has taken."""
        if n not in self._runs:
            self._runs[n] = len(self.merged(MARK * n)) if n else 0
        return self._runs[n]


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        whole = [p for p in vocabulary.pieces if vocabulary.merged(p) == [p] and (p == MARK or p.strip(MARK))]
        self.trie: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for piece in whole:
            node = 0
            for c in piece:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(None)
                node = self.trie[node][c]
            self.ends[node] = piece
        self.column = np.full(0x110000, -1, np.int32)
        letters = sorted(vocabulary.letters)
        for k, c in enumerate(letters):
            self.column[ord(c)] = min(k, COLUMNS)
        # the low code points come first, so text in Latin letters has columns of its own
        self.column[ord(MARK)] = min(letters.index(MARK), COLUMNS - 1)
        if len(letters) > COLUMNS:
            self.column[ord(letters[COLUMNS - 1])] = COLUMNS
            self.column[ord(MARK)] = COLUMNS - 1
        self.below: list[tuple[str, ...] | None] = [None] * len(self.trie)
        for node in reversed(range(len(self.trie))):
            parts = [self.below[child] for child in self.trie[node].values()]
            if all(x is not None for x in parts):
                pieces = sum(((() if self.ends[child] is None else (self.ends[child],)) + x for child, x in zip(self.trie[node].values(), parts, strict=True)), ())
                self.below[node] = pieces if len(pieces) <= LISTED else None
        self.clear()

    def full(self) -> bool:
        return len(self.states) > KEPT_STATES or len(self.apart) + len(self.possible) > KEPT_PAIRS

    def clear(self) -> None:
        """Forget every state and every judgement; those in use are made again."""
        self.apart: dict[int, bool] = {}
        self.possible: dict[tuple[int, str], frozenset | None] = {}
        self.vocabulary.forget()
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.rare: dict[tuple[int, int], tuple[int, int]] = {}
        self.to = np.full((1024, COLUMNS + 1), -1, np.int32)
        self.emits = np.zeros((1024, COLUMNS + 1), np.int8)
        self.mark_alone = np.zeros(1024, bool)
        self.start = self._state(((0, None, 0, False),))

    def _state(self, state: tuple) -> int:
        if state not in self.number:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            if n == len(self.to):
                self.to = np.concatenate([self.to, np.full_like(self.to, -1)])
                self.emits = np.concatenate([self.emits, np.zeros_like(self.emits)])
                self.mark_alone = np.concatenate([self.mark_alone, np.zeros_like(self.mark_alone)])
            self.mark_alone[n] = state[0][3]
        return self.number[state]

    def _stay_apart(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        pair = self.vocabulary.pieces[left] << 32 | self.vocabulary.pieces[right]
        if pair not in self.apart:
            self.apart[pair] = self.vocabulary.stay_apart(left, right)
        return self.apart[pair]

    def _narrowed(self, node: int, last: str | frozenset | None) -> str | frozenset | None:
        """What is worth knowing of the piece before: where few pieces may still follow, just which of them can."""
        if last is None or (pieces := self.below[node]) is None:
            return last
        if isinstance(last, frozenset):
            return last.intersection(pieces)
        if (node, last) not in self.possible:
            self.possible[node, last] = frozenset(p for p in pieces if self._stay_apart(last, p))
        return self.possible[node, last]

    def _step(self, state: int, letter: str) -> tuple[int, int]:
        """(next state, tokens emitted)."""
        running, chosen = [], None
        for node, last, fewer, alone in self.states[state]:
            if (child := self.trie[node].get(letter)) is None:
                continue
            piece = self.ends[child]
            if piece is not None and chosen is None and (piece in last if isinstance(last, frozenset) else self._stay_apart(last, piece)):
                chosen = piece, fewer + 1, (piece == MARK if last is None else alone)
            if self.trie[child] and (narrow := self._narrowed(child, last)) != frozenset():
                running.append((child, narrow, fewer, alone))
        piece, emitted, alone = chosen
        return self._state(((0, piece, 0, alone), *((c, p, f - emitted, a) for c, p, f, a in running))), emitted

    def run(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, tokens) of each stretch of code points, all stepping together."""
        order = np.argsort(-lengths, kind="stable")
        begin, state, emitted = starts[order], entry[order].astype(np.int64), np.zeros(len(order), np.int64)
        still = len(order) - np.searchsorted(lengths[order][::-1], np.arange(int(lengths.max(initial=0))), "right")
        for t, n in enumerate(still):
            letter = points[begin[:n] + t]
            column, at = self.column[letter], state[:n]
            nxt, out = self.to[at, column], self.emits[at, column].astype(np.int64)
            missing = np.flatnonzero(nxt < 0)
            if len(missing):
                keys, back = np.unique(at[missing] << 21 | letter[missing], return_inverse=True)
                found = np.array([self._reach(int(k) >> 21, int(k) & 0x1FFFFF) for k in keys], np.int64)[back]
                nxt = nxt.astype(np.int64)
                nxt[missing], out[missing] = found[:, 0], found[:, 1]
            state[:n] = nxt
            emitted[:n] += out
        ended, total = np.empty_like(state), np.empty_like(emitted)
        ended[order], total[order] = state, emitted
        return ended, total

    def _reach(self, state: int, point: int) -> tuple[int, int]:
        column = self.column[point]
        if column == COLUMNS:
            if (state, point) not in self.rare:
                self.rare[state, point] = self._step(state, chr(point))
            return self.rare[state, point]
        if self.to[state, column] < 0:
            nxt, out = self._step(state, chr(point))
            self.to[state, column], self.emits[state, column] = nxt, out
        return int(self.to[state, column]), int(self.emits[state, column])

    def chunk_maps(self, points: np.ndarray, start: int, length: int) -> list[StateMap]:
        """The map of each chunk of one long stretch, over the entries that can occur in it."""
        heads = np.arange(0, length, CHUNK)
        sizes = np.minimum(CHUNK, length - heads)
        warm = np.minimum(heads, WARM_UP)
        likely, _ = self.run(points, start + heads - warm, warm, np.full(len(heads), self.start))
        maps: list[StateMap] = [{} for _ in heads]
        missing = [(k, int(e)) for k, e in enumerate(likely)]
        while missing:
            chunk, entry = (np.array(x) for x in zip(*missing, strict=True))
            left, tokens = self.run(points, start + heads[chunk], sizes[chunk], entry)
            for (k, e), to, n in zip(missing, left.tolist(), tokens.tolist(), strict=True):
                maps[k][e] = to, n
            missing = [(k, e) for k in range(1, len(maps)) for e in {to for to, _ in maps[k - 1].values()} - maps[k].keys()]
        return maps

    def long_run(self, points: np.ndarray, start: int, length: int) -> tuple[int, int]:
        """(exit state, tokens) of one long stretch: its chunks' maps, composed."""
        return prefix_maps(self.chunk_maps(points, start, length))[-1][self.start]


#: Entry state to (exit state, tokens emitted on the way).
StateMap = dict[int, tuple[int, int]]


def composed(first: StateMap, second: StateMap) -> StateMap:
    """The map of two stretches one after the other; ``second`` knows every exit of ``first``."""
    return {entry: (second[to][0], n + second[to][1]) for entry, (to, n) in first.items()}


def prefix_maps(maps: list[StateMap]) -> list[StateMap]:
    """The map of each prefix of stretches, by doubling: every step composes all maps with those a power of two before."""
    step = 1
    while step < len(maps):
        maps = [*maps[:step], *(composed(maps[k - step], maps[k]) for k in range(step, len(maps)))]
        step *= 2
    return maps


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with a word mark before each text that is not empty, blanks as word marks; where texts begin."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
    some = np.flatnonzero(np.diff(heads) > 0)
    points = np.insert(points, heads[some], ord(MARK)).astype(np.int64)
    points[points == 0x20] = ord(MARK)
    more = np.zeros(len(heads), np.int64)
    more[some + 1] = 1
    return points, heads + np.cumsum(more)


def _hash_stretches(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    powers = np.multiply.accumulate(np.full(int(lengths.max(initial=1)), _STEP, np.uint64))
    ends = np.cumsum(lengths)
    inner = np.arange(int(ends[-1])) - np.repeat(ends - lengths, lengths)
    values = mixed(points[inner + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(7)) * powers[inner]
    return mixed(np.add.reduceat(values, ends - lengths) + lengths.astype(np.uint64))


def count_tokens(machine: Transducer, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text of a slice."""
    points, heads = _points(data, offsets)
    if not len(points):
        return np.zeros(len(offsets) - 1, np.int64)
    if machine.full():
        machine.clear()
    known = machine.column[points] >= 0
    utf8 = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    tokens = np.where(known, 0, utf8)
    mark = points == ord(MARK)
    first = np.zeros(len(points), bool)
    first[heads[:-1][heads[:-1] < len(points)]] = True
    previous = lambda x: np.append(False, x[:-1]) & ~first
    # runs of word marks, counted at their first mark as if no word took the last one
    run_heads = np.flatnonzero(mark & ~previous(mark))
    run_ends = np.flatnonzero(mark & ~np.append(mark[1:] & ~first[1:], False)) + 1
    run_of = run_ends - run_heads
    letters = known & ~mark
    follows = np.append(letters[1:] & ~first[1:], False)
    word_heads = np.flatnonzero(letters & ~previous(letters))
    word_ends = np.flatnonzero(letters & ~follows) + 1
    marked = mark[np.maximum(word_heads - 1, 0)] & (word_heads > 0) & ~first[word_heads]
    starts = word_heads - marked
    lengths = word_ends - starts
    run_tokens = np.zeros(len(points), np.int64)
    sizes, back = np.unique(run_of, return_inverse=True)
    whole = np.array([machine.vocabulary.mark_tokens(int(n)) for n in sizes], np.int64)[back]
    less = np.array([machine.vocabulary.mark_tokens(int(n) - 1) for n in sizes], np.int64)[back]
    run_tokens[run_heads] = whole
    if len(starts):
        _, pick, place = np.unique(_hash_stretches(points, starts, lengths), return_index=True, return_inverse=True)
        s, n = starts[pick], lengths[pick]
        state, total = np.zeros(len(pick), np.int64), np.zeros(len(pick), np.int64)
        short = n <= CHUNK
        state[short], total[short] = machine.run(points, s[short], n[short], np.full(int(short.sum()), machine.start))
        for k in np.flatnonzero(~short):
            state[k], total[k] = machine.long_run(points, int(s[k]), int(n[k]))
        alone = machine.mark_alone[state][place]
        tokens[starts] += total[place]
        # the word's mark is the run's last: a word that left it alone gives it back to the run
        at = np.searchsorted(run_ends, word_heads[marked])
        tokens[run_heads[at]] += np.where(alone[marked], -1, less[at] - whole[at])
    tokens += run_tokens
    sums = np.append(0, np.cumsum(tokens))
    return sums[heads[1:]] - sums[heads[:-1]]


def machine_for(path: str) -> Transducer:
    cache = worker_cache()
    if cache.get("transducer_path") != path:
        cache["transducer"], cache["transducer_path"] = Transducer(Vocabulary(path)), path
    return cache["transducer"]


def token_counts(documents: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``documents`` (doc_id, text).

    NULL and empty texts have no bytes and no tokens. Rows are counted one by one, so NULL and repeated ids keep
    their rows; other columns are left out. ``path`` names the model file, which every executor can read.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_for(path)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                n = pa.array(count_tokens(machine, data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:end], pa.array(np.diff(offsets)), n], ["doc_id", "n_bytes", "n_tokens"])

    found = documents.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
