"""Differing keys from an invertible sketch of the difference of two frames.

Every row is an item: 128 bits of its key's digest and all 256 bits of its row's digest. An item is added to three of a
fixed number of cells, one in each of three parts, with sign + for the source and - for the target. Cells only hold
sums, so a task sends one row per cell whatever it read, and rows equal on both sides cancel. A cell that is left with
one kind of item gives it back by division; taking that item out of its other cells opens further ones. Where all cells
come out empty, the items found are exactly the difference, and only rows with one of their keys are read again.

A sketch of C cells gives back about C / 1.25 items. The sketch is tried in the sizes of ``SIZES``, which bound what
the driver sees; beyond the largest the two frames are compared in full.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import digest
from evenkeel.functions.canon import canonical, column, type_of
from evenkeel.operators.localize import differing_keys, differing_rows_of

#: Cells in each of the three parts.
SIZES = (1 << 12, 1 << 16)
KEY_WORDS, ROW_WORDS = 2, 4
_WORDS = [f"_k{i}" for i in range(KEY_WORDS)] + [f"_w{i}" for i in range(ROW_WORDS)]
_HALVES = [f"{w}{half}" for w in _WORDS for half in ("h", "l")]
_LOW = 0xFFFFFFFF


def with_key_words(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` with 128 bits of the digest of its canonical key as ``_k0`` and ``_k1``."""
    text = F.concat_ws("\x1f", *[canonical(column(k), type_of(df, k)) for k in key])
    hashed = df.withColumn("_key_hash", F.sha2(text, 256))
    words = [digest.hash_word(F.col("_key_hash"), i).alias(f"_k{i}") for i in range(KEY_WORDS)]
    return hashed.select("*", *words).drop("_key_hash")


def _places(size: int) -> list[str]:
    """The cell of an item in each part, as SQL over its words; ``_places_of`` says the same of arrays."""
    return [f"pmod(_k0 ^ _w0, {size}L)", f"pmod(_k1 ^ _w1, {size}L) + {size}L", f"pmod(shiftright(_k0, 7) ^ _w2, {size}L) + {2 * size}L"]


def _places_of(words: np.ndarray, size: int) -> np.ndarray:
    k0, k1, w0, w1, w2 = (words[:, i] for i in range(5))
    return np.stack([np.mod(k0 ^ w0, size), np.mod(k1 ^ w1, size) + size, np.mod((k0 >> 7) ^ w2, size) + 2 * size], axis=1)


def sketched(source: DataFrame, target: DataFrame, size: int) -> DataFrame:
    """(cell, n, check, halves of the words): the cells of two frames of words that are not empty."""
    both = source.withColumn("_d", F.lit(1).cast("bigint")).unionByName(target.withColumn("_d", F.lit(-1).cast("bigint")))
    guard = " ^ ".join(_WORDS)
    halves = [F.expr(f"_d * shiftrightunsigned({w}, 32) AS {w}h") for w in _WORDS] + [F.expr(f"_d * ({w} & {_LOW}L) AS {w}l") for w in _WORDS]
    cells = F.expr(f"explode(array({', '.join(_places(size))})) AS cell")
    items = both.select("_d", F.expr(f"_d * (({guard}) & {_LOW}L) AS check"), *halves, cells)
    sums = [F.sum(c).alias(c) for c in ("check", *_HALVES)]
    folded = items.groupBy("cell").agg(F.sum("_d").alias("n"), *sums)
    return folded.where(" OR ".join(f"{c} <> 0" for c in ("n", "check", *_HALVES)))


def _words(halves: np.ndarray) -> np.ndarray:
    return ((halves[:, 0::2].astype(np.uint64) << np.uint64(32)) | halves[:, 1::2].astype(np.uint64)).view(np.int64)


def peeled(cells: np.ndarray, sums: np.ndarray, size: int) -> tuple[np.ndarray, bool]:
    """(words of the items given back, whether that is all of them); ``sums`` holds n, check and the halves."""
    table = np.zeros((3 * size, sums.shape[1]), np.int64)
    table[cells] = sums
    found, open_cells = [], np.flatnonzero(table.any(axis=1))
    while len(open_cells):
        rows = table[open_cells]
        n = np.where(rows[:, :1] == 0, 1, rows[:, :1])
        whole = rows[:, 1:] // n
        pure = (rows[:, 0] != 0) & (whole * n == rows[:, 1:]).all(axis=1) & ((whole >= 0) & (whole <= _LOW)).all(axis=1)
        words = _words(whole[:, 1:])
        pure &= (np.bitwise_xor.reduce(words, axis=1) & _LOW) == whole[:, 0]
        pure &= (_places_of(words, size) == open_cells[:, None]).any(axis=1)
        if not pure.any():
            return np.concatenate(found) if found else np.zeros((0, len(_WORDS)), np.int64), False
        _, pick = np.unique(words[pure], axis=0, return_index=True)
        words, rows = words[pure][pick], rows[pure][pick]
        places = _places_of(words, size)
        for part in range(3):
            np.subtract.at(table, places[:, part], rows)
        found.append(words)
        open_cells = np.unique(np.concatenate([open_cells, places.ravel()]))
        open_cells = open_cells[table[open_cells].any(axis=1)]
    return np.concatenate(found) if found else np.zeros((0, len(_WORDS)), np.int64), True


def _difference(source: DataFrame, target: DataFrame, size: int) -> tuple[np.ndarray, bool]:
    """Collects one row per cell that is not empty, at most 3 * size of them."""
    table = sketched(source, target, size).toArrow()
    sums = np.column_stack([np.asarray(table[c], np.int64) for c in ("n", "check", *_HALVES)]) if table.num_rows else np.zeros((0, 2 + len(_HALVES)), np.int64)
    return peeled(np.asarray(table["cell"], np.int64), sums, size)


def keys_by_sketch(
    source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], sizes: Sequence[int] = SIZES
) -> DataFrame:
    """(key..., side, n_source, n_target) for each key whose rows differ, as ``localize.differing_keys`` gives it.

    Keys may repeat on either side and may be NULL. Rows that are equal on both sides are never shuffled. With more
    differences than the largest sketch gives back, both frames are compared in full.
    """
    sides = [differing_rows_of(with_key_words(df, key), key, columns, keep=["_k0", "_k1"]) for df in (source, target)]
    for size in sizes:
        found, complete = _difference(*[df.select(*_WORDS) for df in sides], size)
        if complete:
            break
    else:
        return differing_keys(source, target, key, columns, buckets=None)
    hashes = pa.table({"_k0": pa.array(found[:, 0]), "_k1": pa.array(found[:, 1])})
    # at most 3 * size pairs of numbers
    wanted = F.broadcast(source.sparkSession.createDataFrame(hashes).distinct())
    some = [df.join(wanted, ["_k0", "_k1"], "left_semi").drop("_k0", "_k1") for df in sides]
    return differing_keys(*some, key, columns, buckets=None, hashed=True)
