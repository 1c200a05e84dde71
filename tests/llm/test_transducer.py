"""Counts against the tokenizer library itself."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import transducer

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.Vocabulary(PATH))


def counts(machine, texts):
    data = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(x) for x in data])).astype(np.int64)
    return list(transducer.count_tokens(machine, np.frombuffer(b"".join(data), np.uint8), offsets))


def wanted(texts):
    return [len(LIBRARY.encode(t, num_threads=1)) for t in texts]


FIXED = [
    "", " ", "  ", "a", "the quick brown fox", " lead", "trail ", "a  b   c    d", "\n\t x", "▁a ▁", "é", " é  é",
    "中文 text 中", "\U0001f600 x\U0001f600y", "<s> </s> <unk> <0x0A>", "x" * 5000, "ab" * 4000 + " end", " " * 500, "a" + " " * 37 + "b",
    "function   (x) {\r\n\treturn   x;}", "\x00\x01", "é", "1234567890 3.14", "========//////// ction ystem", "ﬁ 　 ",
]


def test_fixed_texts(machine):
    assert counts(machine, FIXED) == wanted(FIXED)


def test_runs_of_blanks(machine):
    texts = [" " * n + w for n in range(1, 70) for w in ("", "word", "é", "✂x", "中")]
    assert counts(machine, texts) == wanted(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(machine, texts):
    assert counts(machine, texts) == wanted(texts)


def test_syllable_words_and_long_words(machine, monkeypatch):
    rng = random.Random(3)
    parts = [LIBRARY.id_to_piece(i).replace("▁", "") for i in range(259, 9000)]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(200)) for _ in range(20)]
    texts.append("".join(rng.choices(parts, k=4000)))
    monkeypatch.setattr(transducer, "CHUNK", 64)
    monkeypatch.setattr(transducer, "WARM_UP", 4)
    assert counts(machine, texts) == wanted(texts)


def test_maps_of_chunks_compose_associatively(machine, monkeypatch):
    monkeypatch.setattr(transducer, "CHUNK", 16)
    monkeypatch.setattr(transducer, "WARM_UP", 0)
    rng = random.Random(9)
    text = "".join(rng.choice(["inter", "nation", "al", "ization", "e", "===", "//"]) for _ in range(300))
    points = np.array([ord(c) for c in text])
    maps = machine.chunk_maps(points, 0, len(points))
    a, b, c = maps[3:6]
    assert transducer.composed(transducer.composed(a, b), c) == transducer.composed(a, transducer.composed(b, c))
    state, total = machine.start, 0
    for k, prefix in enumerate(transducer.prefix_maps(maps)):
        exits, tokens = machine.run(points, np.array([16 * k]), np.array([min(16, len(points) - 16 * k)]), np.array([state]))
        state, total = int(exits[0]), total + int(tokens[0])
        assert prefix[machine.start] == (state, total)


def test_table_is_dropped_and_made_again(machine, monkeypatch):
    monkeypatch.setattr(transducer, "KEPT_STATES", 3)
    assert counts(machine, FIXED) == wanted(FIXED) and counts(machine, FIXED) == wanted(FIXED)
    monkeypatch.setattr(transducer, "KEPT_STATES", 10**9)
    monkeypatch.setattr(transducer, "KEPT_PAIRS", 3)
    assert counts(machine, FIXED) == wanted(FIXED)
    assert len(machine.apart) > 3 and machine.full()


def test_frame(spark):
    rows = [(1, "a b", 7), (1, "a b", 7), (None, None, 1), (3, "", 1), (4, "w " * 5000, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in transducer.token_counts(frame, PATH).collect()}
    assert found == {(1, 3, 2, False), (None, 0, 0, False), (3, 0, 0, False), (4, 10000, 5001, True)}
    assert transducer.token_counts(frame.limit(0), PATH).count() == 0
