"""Segmentations against an exhaustive search, decoding against the text."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return lattice.Lattice(PATH)


def all_paths(pieces, text):
    """(score, ids) of every segmentation, best first."""
    text = "▁" + text.replace(" ", "▁") if text else ""
    v = pieces.vocabulary
    ways = {len(text): [(0.0, ())]}
    for i in reversed(range(len(text))):
        ways[i] = []
        if text[i] not in v.letters:
            own = tuple(v.byte_ids[b] for b in text[i].encode())
            ways[i] += [(pieces.unknown + s, own + ids) for s, ids in ways[i + 1]]
        for j in range(i + 1, min(i + 16, len(text)) + 1):
            if text[i:j] in v.pieces:
                p = v.pieces[text[i:j]]
                ways[i] += [(v.scores[p] + s, (p, *ids)) for s, ids in ways[j]]
    return sorted(ways[0], key=lambda x: -x[0])


def encoded(pieces, texts, n):
    data = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(x) for x in data])).astype(np.int64)
    ids, heads, score, best = lattice.encode_slice(pieces, np.frombuffer(b"".join(data), np.uint8), offsets, n)
    return [([int(x) for x in ids[heads[t] : heads[t + 1]]], float(score[t]), best[t]) for t in range(len(texts))]


def changed(ids, changes):
    out = list(ids)
    for first, end, new in sorted(changes, reverse=True):
        out[first:end] = new
    return tuple(out)


def check(pieces, texts, n):
    for text, (ids, score, best) in zip(texts, encoded(pieces, texts, n), strict=True):
        paths = all_paths(pieces, text)
        assert score == paths[0][0]
        assert [s for s, _ in best] == [s for s, _ in paths[:n]]
        found = [changed(ids, c) for _, c in best]
        assert len(set(found)) == len(found) and found[0] == tuple(ids)
        assert {(s, i) for (s, _), i in zip(best, found, strict=True)} <= set(paths)
        assert pieces.decode(np.array(ids, np.int64)).decode() == text.replace("▁", " ")


def test_fixed(pieces):
    check(pieces, ["", " ", "  a", "the cat", "tion the", "a a a", "é✂x", "中x \U0001f600", "\t\n", "▁a", "then  in", "x"], 5)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abent ▁é✂中.", max_size=9), max_size=4), st.integers(1, 6))
def test_any(pieces, texts, n):
    check(pieces, texts, n)


def test_long_word_and_long_text(pieces):
    rng = random.Random(1)
    texts = ["x" * 3000, " ".join("".join(rng.choices(["er", "th", "tion", "é"], k=3)) for _ in range(3000))]
    for text, (ids, _, best) in zip(texts, encoded(pieces, texts, 4), strict=True):
        assert pieces.decode(np.array(ids, np.int64)).decode() == text
        assert [s for s, _ in best] == sorted((s for s, _ in best), reverse=True) and len(best) == 4
        for s, changes in best:
            new = changed(ids, changes)
            assert sum(pieces.scores[list(new)]) == s and pieces.decode(np.array(new)).decode() == text


def test_frames(spark):
    rows = [(1, "a b", 7), (1, "a b", 7), (None, None, 1), (3, "", 1), (4, "ça ✂ va", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = lattice.encode(frame, PATH)
    for r in found.collect():
        assert r.restored and r.n_pieces == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}i", *r.ids)).hexdigest()
    texts = sorted(lattice.decode(found, PATH).collect(), key=str)
    assert [(r.doc_id, r.text) for r in texts] == sorted([(i, t or "") for i, t, _ in rows], key=lambda x: str(x)) or {
        (r.doc_id, r.text) for r in texts
    } == {(i, t or "") for i, t, _ in rows}
    assert lattice.encode(frame.limit(0), PATH, keep_ids=False).count() == 0
