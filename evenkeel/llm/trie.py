"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Vectors of integers are cut into equal parts. Codebooks are refined by rounds of assigning parts and averaging them,
all in integers, so that results are exact and do not depend on the order of rows.

Distances are found along a lexicographic trie over the distinct parts. Sorted parts are its leaves in depth-first
order, and the place where a part first differs from the one before is the depth at which the traversal turns back.
A node holds, for every entry, the distance summed over the dimensions of its prefix; parts below it start from that
vector instead of from zero. ``walk`` takes the leaves in blocks: within a block each level's new nodes are computed
together from their parents, and the path to a block's last leaf is carried into the next block, as a stack would
hold it. A leaf takes the argmin over entries (ties to the lower number) and, with its weight, adds its part to the
entry's sums.

Spark counts the distinct parts once, ranges them over tasks in lexicographic order and writes them; each round reads
that table, and only sums per codebook entry leave a task. Executors may be lost at any time: every round can be run
again from the written table.

Rows whose vector is NULL, or holds NULL or a value that is not finite, are left out. Repeated rows are coded each and
weigh in the averages each; NULL ids and labels are kept; other columns are not read. Components of LARGEST or more,
once scaled, are refused with an error, as their squares would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.tables import written

#: Leaves handled at once; a block's nodes take at most this many vectors of distances a level.
BLOCK = 4096
#: Components beyond this size are refused: squared distances and sums must fit 64 bits.
LARGEST = 1 << 27
#: Labels up to this number are broadcast with their sums of errors.
BROADCAST_LABELS = 100_000


def packed_parts(rows: np.ndarray) -> np.ndarray:
    """Rows of integers as fixed-width bytes that sort as the rows do, component by component."""
    return (rows.astype(np.int64) + (1 << 31)).astype(">u4").view(f"S{4 * rows.shape[1]}").ravel()


def unpacked_parts(keys: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u4").reshape(-1, width).astype(np.int64) - (1 << 31)


def walk(rows: np.ndarray, entries: np.ndarray, block: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, its squared distance) of each row of ``rows``, which are distinct and sorted."""
    n, width = rows.shape
    block = block or BLOCK
    nearest, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    path: list[np.ndarray] = []
    for first in range(0, n, block):
        part = rows[first : first + block]
        # depth at which each leaf leaves the path of the leaf before
        leaves = np.zeros(len(part), np.int64)
        before = rows[max(first - 1, 0) : first + len(part) - 1] if first else np.vstack([part[:1], part[:-1]])
        if width:
            differs = part != before
            leaves = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        if not first:
            leaves[0] = 0
        # node of each leaf on the level above, and that level's vectors; the stack gives what is carried in
        above, owner = np.zeros((1, len(entries)), np.int64), np.zeros(len(part), np.int64)
        carried: list[np.ndarray] = []
        for depth in range(width):
            new = leaves <= depth
            number = np.cumsum(new)
            heads = np.flatnonzero(new)
            steps = part[heads, depth, None] - entries[None, :, depth]
            made = above[owner[heads]] + steps * steps
            # number 0 is the carried node, for leaves that stay on the path of the block before
            level = np.vstack([path[depth][None, :] if path else np.zeros((1, len(entries)), np.int64), made])
            above, owner = level, number
            carried.append(level[owner[-1]])
        sums = above[owner]
        path = carried
        nearest[first : first + len(part)] = sums.argmin(axis=1)
        distance[first : first + len(part)] = sums.min(axis=1)
    return nearest, distance


def distinct_rows(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, place of each row among them, weight of each)."""
    if not len(rows) or not rows.shape[1]:
        shape = np.zeros((min(len(rows), 1), rows.shape[1]), np.int64)
        total = np.array([len(rows) if weights is None else weights.sum()] if len(rows) else [], np.int64)
        return shape, np.zeros(len(rows), np.int64), total
    order = np.lexsort(rows.T[::-1])
    ranked = rows[order]
    new = np.append(True, (ranked[1:] != ranked[:-1]).any(axis=1))
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    each = np.ones(len(rows), np.int64) if weights is None else weights
    return ranked[new], place, np.add.reduceat(each[order], np.flatnonzero(new))


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` is an array of entries by dimensions."""

    entries: list[np.ndarray]

    def sha256(self) -> str:
        """Of all entries' components as decimal numbers, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for entry in part for x in entry).encode()).hexdigest()


def integer_parts(df: DataFrame, id_column: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component of rows whose vectors are whole and finite."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(x.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_column).alias("vec_id"), "label", scaled.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of one width; shorter vectors count as ending in zeros."""
    flat, lengths = np.asarray(column.flatten(), np.int64), np.asarray(column.value_lengths(), np.int64)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"components must be smaller than {LARGEST} once scaled")
    matrix = np.zeros((len(lengths), width), np.int64)
    matrix[np.arange(width)[None, :] < lengths[:, None]] = flat
    return matrix


def _counted(width: int, parts: int):
    """Distinct parts of each batch with how often they occur, so that copies meet before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width // parts
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            for p in range(parts):
                some, _, weight = distinct_rows(rows[:, p * size : (p + 1) * size])
                keys = packed_parts(np.ascontiguousarray(some)).tolist() if size else [b""] * len(some)
                keys = [k.ljust(4 * size, b"\0") for k in keys]
                yield pa.record_batch([pa.array([p] * len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array(weight, pa.int64())], ["part", "key", "weight"])

    return count


def part_counts(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """(part, key, weight): the distinct parts in lexicographic order, written to the shared folder.

    Copies are counted per batch, then meet in a range shuffle on the order itself, whose ranges a sample balances and
    which the aggregation after it reuses.
    """
    counted = vectors.select("v").mapInArrow(_counted(width, parts), "part int, key binary, weight long")
    ranged = counted.repartitionByRange("part", "key").groupBy("part", "key").agg(F.sum("weight").alias("weight"))
    return written(ranged.sortWithinPartitions("part", "key"), "parts")


def _round(size: int, books: list[np.ndarray]):
    """Sums of weights and components per entry over the parts a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), size + 1), np.int64) for b in books]
        for batch in batches:
            of, weight = np.asarray(batch.column("part")), np.asarray(batch.column("weight"))
            keys = batch.column("key").to_pylist()
            for p in np.unique(of):
                inside = np.flatnonzero(of == p)
                rows = unpacked_parts([keys[i] for i in inside], size) if size else np.zeros((len(inside), 0), np.int64)
                nearest, _ = walk(rows, books[p])
                weighted = np.column_stack([weight[inside], rows * weight[inside, None]])
                np.add.at(sums[p], nearest, weighted)
        found = [(p, e, s) for p, part in enumerate(sums) for e, s in enumerate(part.tolist()) if s[0]]
        yield pa.record_batch(
            [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.list_(pa.int64()))],
            ["part", "entry", "sums"],
        )

    return run


def refined(counts: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """``rounds`` times: assign every part, replace each used entry by the rounded-down mean of its parts."""
    size = books.entries[0].shape[1]
    for _ in range(rounds):
        sums = counts.mapInArrow(_round(size, books.entries), "part int, entry int, sums array<long>")
        # a few numbers per entry and task; one row per entry reaches the driver
        added = sums.groupBy("part", "entry").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(size + 1)]).alias("sums"))
        entries = [b.copy() for b in books.entries]
        for row in added.collect():
            entries[row["part"]][row["entry"]] = [x // row["sums"][0] for x in row["sums"][1:]]
        books = Codebooks(entries)
    return books


def train(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks of ``vectors`` (vec_id, v), begun with the parts of the smallest ids.

    Of repeated ids the smaller vector comes first. Fewer rows than entries give fewer entries; no rows give none.
    NULL ids come last. Shorter vectors, and a width that ``parts`` does not divide, are filled with zeros.
    """
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    size = -(-longest // parts)
    width = size * parts
    rows = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in first], np.int64).reshape(len(first), width)
    books = Codebooks([rows[:, p * size : (p + 1) * size] for p in range(parts)])
    return refined(part_counts(vectors, width, parts), books, rounds) if first else books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors`` with code (two hex digits for each part) and error (squared distances summed over parts).

    Codebooks hold at most 256 entries. The trie is over the distinct parts of each Arrow batch.
    """
    parts, size = len(books.entries), books.entries[0].shape[1]
    if len(books.entries[0]) > 256:
        raise ValueError("two hex digits name at most 256 entries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}".encode() for i in range(256)])
        for batch in batches:
            rows = _matrix(batch.column("v"), parts * size)
            code, error = np.zeros((len(rows), parts), "S2"), np.zeros(len(rows), np.int64)
            for p in range(parts):
                some, place, _ = distinct_rows(rows[:, p * size : (p + 1) * size])
                nearest, distance = walk(some, books.entries[p]) if len(some) else (place, place)
                code[:, p] = digits[nearest[place]]
                error += distance[place]
            text = np.ascontiguousarray(code).view(f"S{2 * parts}").ravel().astype(str) if len(rows) else []
            keep = [batch.column(n) for n in ("vec_id", "label")]
            yield pa.record_batch([*keep, pa.array(text, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.select("vec_id", "label", "v").mapInArrow(run, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error: error summed over rows of the same label; NULL labels are one.

    The sums are broadcast where their counted rows are few; else they are joined, and skewed labels split.
    """
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    sums = written(sums, "label-errors")
    side = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return coded.join(side, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
