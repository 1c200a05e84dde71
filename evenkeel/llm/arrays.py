"""Texts of an Arrow batch as flat NumPy arrays: words, hashes and packed columns.

Everything here works on one slice of a batch at a time, so memory follows ``SLICE_BYTES`` (or the
longest single text) and never the size of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
SLICE_BYTES = 6 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_random = np.random.default_rng(20240917)
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = np.asarray(values, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of an ordered pair of hashes."""
    return mixed(left * _BASE + (right ^ np.uint64(0xD1B54A32D192ED03)))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows holding ``limit`` bytes or one text; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset :][: len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word in order, words before each text): words are runs without white space."""
    inside = ~_WHITE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    counts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    place = np.flatnonzero(inside)
    heads = np.searchsorted(place, starts)
    lengths = np.diff(np.append(heads, len(place)))
    in_word = np.arange(len(place)) - np.repeat(heads, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, np.uint64))
    values = _BYTE_VALUE[_LOWER[data[place]]] * powers[in_word]
    return mixed(np.add.reduceat(values, heads) + lengths.astype(np.uint64)), counts


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(column: pa.ChunkedArray | pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a binary column, how many each row holds)."""
    if isinstance(column, pa.ChunkedArray):
        parts = [unpacked(x, kind) for x in column.chunks]
        if not parts:
            return np.zeros(0, kind), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    rows = [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in column]
    if not rows:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return np.concatenate(rows), np.array([len(r) for r in rows])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each start and length, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def worker_cache() -> dict:
    """Values that live as long as the worker process, over all tasks it runs."""
    import sys
    import types

    return vars(sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache")))
