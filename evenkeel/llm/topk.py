"""Exact top-k inner products by block-at-a-time pruning.

Candidates are dealt to shards, and in each cut into blocks of neighbouring ids. A block keeps its forward index (the integer vectors)
and, for every term (dimension), the largest and the smallest component in it. For one query the sum over
its terms of component times largest (or smallest, where the component is negative) bounds every score in
the block. Blocks are taken in falling order of that bound and scored through their forward index until the
next bound falls below the k-th score found; equal bounds are still read, as ties go to the smaller id.

A task searches one shard for one group of queries, both of bounded size. The first shard is searched before the
others; the k-th score a query finds there is a floor below which the other shards need neither read nor return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.tables import written

#: Candidates in a block, blocks in a shard, queries in a group; a task searches one shard for one group.
BLOCK_ROWS, SHARD_BLOCKS, GROUP_QUERIES = 256, 64, 4096


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: float = 64.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows with NULL parts or values that are not finite go."""
    part = F.col(vector)
    sound = part.isNotNull() & F.col(id_column).isNotNull() & ~F.exists(
        part, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return df.where(sound).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(part, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of one width; shorter vectors count as ending in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    width = int(lengths.max()) if len(lengths) else 0
    matrix = np.zeros((len(lengths), width), np.int64)
    inside = np.arange(width)[None, :] < lengths[:, None]
    matrix[inside] = np.asarray(column.flatten(), np.int64)
    return matrix


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def block_search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list[int | None]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of each query's k best rows of another id among ``rows``, best first; none below its floor."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    width = max(rows.shape[1], queries.shape[1])
    rows, queries = _widened(rows, width), _widened(queries, width)
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < 2**53 else object
    rows, queries = rows.astype(kind), queries.astype(kind)
    least = np.array([-np.inf if x is None else x for x in floors], kind)
    heads = np.arange(0, len(ids), BLOCK_ROWS)
    if not len(heads) or not width:
        top, low = np.zeros((len(heads), width), kind), np.zeros((len(heads), width), kind)
    else:
        top, low = np.maximum.reduceat(rows, heads), np.minimum.reduceat(rows, heads)
    bounds = np.maximum(queries, 0).dot(top.T) + np.minimum(queries, 0).dot(low.T)
    turns = np.argsort(-bounds, axis=1, kind="stable")
    best = [(np.zeros(0, np.int64), np.zeros(0, kind)) for _ in query_ids]
    open_queries = np.arange(len(query_ids))
    for turn in range(len(heads)):
        if not len(open_queries):
            break
        blocks = turns[open_queries, turn]
        goes_on = [
            bounds[q, b] >= least[q] and (len(best[q][0]) < k or bounds[q, b] >= best[q][1][-1])
            for q, b in zip(open_queries, blocks, strict=True)
        ]
        open_queries, blocks = open_queries[goes_on], blocks[goes_on]
        for b in np.unique(blocks):
            asked = open_queries[blocks == b]
            part = slice(heads[b], heads[b] + BLOCK_ROWS)
            scores = queries[asked].dot(rows[part].T)
            for q, found in zip(asked, scores, strict=True):
                if len(best[q][0]) == k and found.max() < best[q][1][-1]:
                    continue
                other = (ids[part] != query_ids[q]) & (found >= least[q])
                some_ids = np.concatenate([best[q][0], ids[part][other]])
                some = np.concatenate([best[q][1], found[other]])
                keep = np.lexsort((some_ids, -some))[:k]
                best[q] = some_ids[keep], some[keep]
    for q, (found_ids, found) in enumerate(best):
        yield int(query_ids[q]), found_ids, found


def _searched(asked: DataFrame, candidates: DataFrame, shards: tuple[int, int], groups: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each shard from the first to before the second of ``shards``.

    ``asked`` (group, query_id, q, floor) meets every shard and ``candidates`` (shard, vec_id, v) every group.
    """
    asked = asked.select("*", F.explode(F.sequence(F.lit(shards[0]), F.lit(shards[1] - 1))).alias("shard"))
    inside = (F.col("shard") >= shards[0]) & (F.col("shard") < shards[1])
    dealt = candidates.where(inside).select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and rows.num_rows:
            ids, query_ids = np.asarray(rows["vec_id"], np.int64), np.asarray(queries["query_id"], np.int64)
            floors = queries["floor"].to_pylist()
            out = list(block_search(ids, _matrix(rows["v"]), query_ids, _matrix(queries["q"]), k, floors))
        return pa.table(
            {
                "query_id": np.repeat(np.array([x[0] for x in out], np.int64), np.array([len(x[1]) for x in out], np.int64)),
                "vec_id": np.concatenate([x[1] for x in out]) if out else np.zeros(0, np.int64),
                "score": np.concatenate([x[2] for x in out]).astype(np.int64) if out else np.zeros(0, np.int64),
            }
        )

    keys = ["shard", "group"]
    return asked.groupBy(keys).cogroup(dealt.groupBy(keys)).applyInArrow(search, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k best rows of ``vectors`` (vec_id, v) for each of ``queries`` (vec_id, v), its own id left out.

    Returns query_id, rank (from 1), vec_id, score (long). Ties go to the smaller id; fewer than k rows
    give all. Repeated ids are rows of their own; an empty vector scores 0 with everything. Rows of shards and of
    groups are dealt by the hash of id and vector, so that an id with many vectors is spread.
    A score beyond 63 bits stops the job.
    """
    shards = max(1, -(-vectors.count() // (BLOCK_ROWS * SHARD_BLOCKS)))
    groups = max(1, -(-queries.count() // GROUP_QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    candidates = vectors.select(deal(shards).alias("shard"), "vec_id", "v")
    asked = queries.select(deal(groups).alias("group"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = _searched(asked.withColumn("floor", F.lit(None).cast("long")), candidates, (0, 1), groups, k)
    if shards > 1:
        found = written(found, "first-shard")
        floors = best(found).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        rest = _searched(asked.join(floors, "query_id", "left"), candidates, (1, shards), groups, k)
        found = found.unionByName(rest)
    return best(found).select("query_id", "rank", "vec_id", "score")
