"""Hard negatives by exact Four-Russians scores.

Candidates are packed as bit planes: plane b of a vector holds bit b of each component (two's complement, so the last
plane counts negative), eight dimensions to a byte. For each group of eight dimensions an anchor has a table of its 256
subset sums. The inner product of anchor and candidate is then looked up: for every plane, the sum over the groups of
the table's entry at the candidate's byte, shifted by the plane's number. Sums are whole numbers, so scores are exact.

Candidates are packed where they are read, without a shuffle, in blocks of BLOCK_ROWS; anchors in slices of SLICE_ROWS.
Buckets of blocks meet groups of slices, each pair in one task of bounded size: blocks travel once for every group of
GROUP_ROWS anchors, slices once for every bucket. A first pass scores each anchor with the rows of its own label and
keeps the best as positives, a second scores it with the others and keeps, for each positive, the best inside its band.

Rows with a NULL id, label or vector, or a component that is NULL or not finite, take no part. Repeated rows count
each, as candidates and as anchors; a row is no other row than one of the same id. Ties go to the smaller id. Shorter
vectors count as ending in zeros. No anchors, or none with positives, give no rows. Other columns are not read. Scores
that could pass 2^56 are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.tables import written

#: Rows of a block of candidates, of a slice of anchors; candidates scored at once; anchors of a group; blocks of a bucket.
BLOCK_ROWS, SLICE_ROWS, STRIP_ROWS, GROUP_ROWS, BUCKET_BLOCKS = 2048, 512, 256, 1 << 15, 64
#: Buckets used although fewer would hold the blocks, so that a small table keeps many tasks busy.
SPREAD = 256
NONE = -(2**63) + 1
_ABSENT = 2**63 - 1


def labelled_vectors(df: DataFrame, id_column: str, label: Column, vector: str, scale: float) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component, of the rows that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(F.col(id_column).isNotNull() & label.isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one width, a multiple of eight."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths(), np.int64)
    width = -(-int(lengths.max(initial=0)) // 8) * 8
    matrix = np.zeros((len(lengths), width), np.int64)
    matrix[np.arange(width)[None, :] < lengths[:, None]] = np.asarray(column.flatten(), np.int64)
    return matrix


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes; the last plane is the sign."""
    top, low = int(rows.max(initial=0)), int(rows.min(initial=0))
    planes = max(top.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    out = np.empty((planes, rows.shape[1] // 8, len(rows)), np.uint8)
    for b in range(planes):
        out[b] = np.packbits(((rows >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the components whose bits are set."""
    groups = anchors.shape[1] // 8
    largest = int(np.abs(anchors).max(initial=0)) * max(anchors.shape[1], 1)
    tables = np.zeros((groups, 256, len(anchors)), np.int32 if largest < 2**31 else np.int64)
    for bit in range(8):
        # each further dimension doubles the table: the sums so far, and the same with its component
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + anchors.T[bit::8][:, None, :]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchors, candidates) inner products, from table lookups alone."""
    anchors, rows = tables.shape[2], planes.shape[2]
    out = np.zeros((rows, anchors), np.int64)
    groups = min(tables.shape[0], planes.shape[1])
    for first in range(0, rows, STRIP_ROWS):
        strip = slice(first, min(first + STRIP_ROWS, rows))
        sums = np.empty((strip.stop - first, anchors), tables.dtype)
        looked = np.empty_like(sums)
        for b in range(planes.shape[0]):
            sums[:] = 0
            for g in range(groups):
                np.take(tables[g], planes[b, g, strip], axis=0, out=looked, mode="clip")
                sums += looked
            shifted = sums.astype(np.int64) << b
            if b == planes.shape[0] - 1:
                out[strip] -= shifted
            else:
                out[strip] += shifted
    return out.T


def _packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            ids, labels = np.asarray(part.column("vec_id"), np.int64), np.asarray(part.column("label"), np.int64)
            order = np.argsort(ids, kind="stable")
            rows = _matrix(part.column("v"))[order]
            planes = bit_planes(rows)
            yield pa.RecordBatch.from_pylist(
                [{"ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "planes": planes.tobytes(), "n_planes": len(planes), "largest": int(np.abs(rows).max(initial=0))}],
                schema=pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("planes", pa.binary()), ("n_planes", pa.int32()), ("largest", pa.int64())]),
            )


def _packed_slices(key: tuple, table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    rows = _matrix(table["v"])
    columns = {c: np.asarray(table[c], np.int64) for c in ("vec_id", "label", "copies")}
    order = np.lexsort((columns["vec_id"], columns["label"]))
    out = []
    for number, first in enumerate(range(0, len(order), SLICE_ROWS)):
        part = order[first : first + SLICE_ROWS]
        packed = {c: columns[c][part].tobytes() for c in columns}
        out.append({"group": key[0].as_py(), "slice": number, **packed, "rows": rows[part].tobytes()})
    kinds = [("group", pa.int32()), ("slice", pa.int32()), ("vec_id", pa.binary()), ("label", pa.binary()), ("copies", pa.binary()), ("rows", pa.binary())]
    return pa.Table.from_pylist(out, schema=pa.schema(kinds))


def _longs(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def _slices(table: pa.Table) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, ids, labels, anchors, tables) of each slice."""
    for row in table.to_pylist():
        ids = _longs(row["vec_id"])
        anchors = _longs(row["rows"]).reshape(len(ids), -1)
        yield row, ids, _longs(row["label"]), anchors, subset_sums(anchors)


def _blocks(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    found = []
    for row in table.to_pylist():
        ids = _longs(row["ids"])
        planes = np.frombuffer(row["planes"], np.uint8).reshape(row["n_planes"], -1, len(ids))
        found.append((ids, _longs(row["labels"]), planes, row["largest"]))
    return found


def _checked(anchors: np.ndarray, largest: int) -> None:
    if int(np.abs(anchors).max(initial=0)) * largest * max(anchors.shape[1], 1) >= 2**56:
        raise ValueError("scores of 2^56 and more are not supported")


def best_of(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row and their ids, ties to the smaller id; short rows end in NONE."""
    order = np.lexsort((np.broadcast_to(ids, found.shape), -found), axis=-1)[..., :k]
    some, theirs = np.take_along_axis(found, order, -1), np.take_along_axis(np.broadcast_to(ids, found.shape), order, -1)
    lacking = [(0, 0)] * (found.ndim - 1) + [(0, k - some.shape[-1])]
    return np.pad(some, lacking, constant_values=NONE), np.pad(theirs, lacking, constant_values=_ABSENT)


def _merged(best: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    return best_of(np.concatenate([best[0], more[0]], axis=-1), np.concatenate([best[1], more[1]], axis=-1), k)


def _nothing(*shape: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full(shape, NONE, np.int64), np.full(shape, _ABSENT, np.int64)


def _same_label(k: int):
    def search(slices: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        candidates = _blocks(blocks)
        for row, ids, labels, anchors, tables in _slices(slices):
            best = _nothing(len(ids), k)
            for their_ids, their_labels, planes, largest in candidates:
                _checked(anchors, largest)
                for label in np.intersect1d(labels, their_labels):
                    mine, theirs = np.flatnonzero(labels == label), np.flatnonzero(their_labels == label)
                    found = scores(tables[:, :, mine], planes[:, :, theirs])
                    found[ids[mine][:, None] == their_ids[theirs][None, :]] = NONE
                    more = best_of(found, their_ids[theirs], k)
                    merged = _merged((best[0][mine], best[1][mine]), more, k)
                    best[0][mine], best[1][mine] = merged
            place, turn = np.nonzero(best[0] != NONE)
            out.append((row["group"], row["slice"], place, best[1][place, turn], best[0][place, turn]))
        lengths = [len(x[2]) for x in out]
        joined = lambda i: np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64)
        spread = lambda i: np.repeat(np.array([x[i] for x in out], np.int32), lengths)
        return pa.table({"group": spread(0), "slice": spread(1), "place": joined(2).astype(np.int32), "vec_id": joined(3), "score": joined(4)})

    return search


def _in_band(positives: int, k: int, low: int, high: int):
    def search(slices: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        candidates = _blocks(blocks)
        for row, ids, labels, anchors, tables in _slices(slices):
            # bar[i, j]: the score of anchor i's j-th positive
            bar, positive_id = _nothing(len(ids), positives)
            for p in row["positives"]:
                bar[p["place"], p["rank"] - 1], positive_id[p["place"], p["rank"] - 1] = p["score"], p["vec_id"]
            asked = bar != NONE
            best = _nothing(len(ids), positives, k)
            for their_ids, their_labels, planes, largest in candidates:
                _checked(anchors, largest)
                found = scores(tables, planes)
                found[labels[:, None] == their_labels[None, :]] = NONE
                order = np.argsort(-found, axis=1, kind="stable")
                found = np.take_along_axis(found, order, 1)
                # the first row at or below the upper end of each band, and the k from there
                for j in range(positives):
                    above = (100 * found.clip(-(2**56)) > high * bar[:, j, None].clip(-(2**56))).sum(axis=1)
                    reach = above[:, None] + np.arange(k)[None, :]
                    inside = reach < found.shape[1]
                    reach = np.minimum(reach, found.shape[1] - 1)
                    some = np.take_along_axis(found, reach, 1)
                    theirs = their_ids[np.take_along_axis(order, reach, 1)]
                    held = inside & asked[:, j, None] & (some != NONE) & (100 * some.clip(-(2**56)) >= low * bar[:, j, None].clip(-(2**56)))
                    more = np.where(held, some, NONE), np.where(held, theirs, _ABSENT)
                    best[0][:, j], best[1][:, j] = _merged((best[0][:, j], best[1][:, j]), more, k)
            place, j, turn = np.nonzero(best[0] != NONE)
            if len(place):
                spread = lambda c: np.full(len(place), c, np.int32)
                out.append((spread(row["group"]), spread(row["slice"]), place.astype(np.int32), (j + 1).astype(np.int32), ids[place], _longs(row["copies"])[place],
                            positive_id[place, j], bar[place, j], best[1][place, j, turn], best[0][place, j, turn]))
        names = ["group", "slice", "place", "turn", "anchor_id", "copies", "positive_id", "positive_score", "negative_id", "negative_score"]
        kinds = [np.int32] * 4 + [np.int64] * 6
        return pa.table({n: np.concatenate([x[i] for x in out]) if out else np.zeros(0, kind) for i, (n, kind) in enumerate(zip(names, kinds, strict=True))})

    return search


def _met(slices: DataFrame, blocks: DataFrame, groups: int, buckets: int):
    """Every group of slices with every bucket of blocks, each pair in a group of its own."""
    some = slices.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    others = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # a fixed number of partitions, as small inputs with much work must not be put together
    parts = min(groups * buckets, 20_000)
    key = ["group", "bucket"]
    return some.repartition(parts, *key).groupBy(*key).cogroup(others.repartition(parts, *key).groupBy(*key))


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """Rows of other labels that score almost as high with an anchor as a row of its own label does.

    Both frames are (vec_id, label, v). For each anchor, its ``positives`` best other rows of the same label are found;
    for each of them, with score p, the ``negatives`` best rows of other labels with low * p <= 100 * score <= high * p.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    """
    blocks = written(vectors.select("vec_id", "label", "v").mapInArrow(_packed_blocks, "ids binary, labels binary, planes binary, n_planes int, largest long"), "blocks")
    n_blocks = blocks.count()
    buckets = max(-(-n_blocks // BUCKET_BLOCKS), min(4 * n_blocks, SPREAD), 1)
    blocks = blocks.withColumn("bucket", F.pmod(F.xxhash64("ids", "planes"), F.lit(buckets)).cast("int"))
    each = written(anchors.groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("copies")), "anchors")
    groups = max(1, -(-each.count() // GROUP_ROWS))
    dealt = each.withColumn("group", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(groups)).cast("int"))
    packed = "group int, slice int, vec_id binary, label binary, copies binary, rows binary"
    slices = written(dealt.groupBy("group").applyInArrow(_packed_slices, packed), "slices")

    near = _met(slices, blocks, groups, buckets).applyInArrow(_same_label(positives), "group int, slice int, place int, vec_id long, score long")
    anchor = ["group", "slice", "place"]
    rank = F.row_number().over(Window.partitionBy(*anchor).orderBy(F.desc("score"), "vec_id")).alias("rank")
    chosen = near.select("*", rank).where(F.col("rank") <= positives)
    chosen = chosen.groupBy("group", "slice").agg(F.collect_list(F.struct("place", "rank", "vec_id", "score")).alias("positives"))
    asked = written(slices.join(chosen, ["group", "slice"]), "asked")

    result = "group int, slice int, place int, turn int, anchor_id long, copies long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _met(asked, blocks, groups, buckets).applyInArrow(_in_band(positives, negatives, low, high), result)
    best = Window.partitionBy(*anchor, "turn").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
