"""All links inside clusters of sets, counted for each set, by T-occurrence search over inverted lists.

The sets of a block are indexed by their elements; a list holds ranks by size. For a set that must share T elements with
any partner, the T - 1 longest of its lists are set apart: a partner is in one of the others. Those short lists are
merged, as sorted runs, and every rank met becomes a candidate with its count. Candidates of fitting size are then looked
up in the long lists by binary search, all together, until they have reached or can no longer reach the overlap their
sizes ask for (DivideSkip). Every pair is found, also inside one component; what leaves a task is one row per set.

Clusters above BIN are cut, in order of size, into bins of about that many elements, however many sets the cluster has;
every two bins whose sizes allow a link meet in a task of their own. The number of such tasks grows with the square of a
cluster of different texts, as the number of its links does; their results do not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.jaccard_rules import PERCENT, DisjointSets, least_overlap, needed
from evenkeel.llm.tables import written
from evenkeel.operators.ordered import find_cuts, with_running_sum

#: Elements in a bin, where a set counts for SET_COST more than it has; rows of a cluster that one window task may take.
BIN, SET_COST, WINDOW_ROWS = 400_000, 100, 1_000_000


class Lists:
    """Inverted lists of sets, whose ranks are their places in order of ``sizes``."""

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray]):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.order]
        ranked = [sets[i] for i in self.order]
        values = np.concatenate(ranked) if ranked else np.zeros(0, np.uint64)
        ranks = np.repeat(np.arange(len(ranked)), [len(s) for s in ranked])
        by_value = np.argsort(values, kind="stable")
        values, self.members = values[by_value], ranks[by_value]
        heads = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
        self.values, self.edges = values[heads], np.append(heads, len(values))

    def linked(self, size: int, own: np.ndarray, below: int | None = None) -> np.ndarray:
        """Ranks (under ``below``) of the sets that are similar enough to one of ``size`` elements, ``own`` of them shared ones."""
        low = int(np.searchsorted(self.sizes, least_overlap(size)))
        high = int(np.searchsorted(self.sizes, size * 100 // PERCENT, "right"))
        high = high if below is None else min(high, below)
        if low >= high or not len(self.values):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        least = needed(size, int(self.sizes[low]))
        if not len(at) or len(at) < least:
            return np.zeros(0, np.int64)
        at = at[np.argsort(self.edges[at + 1] - self.edges[at], kind="stable")]
        lists = [self.members[self.edges[k] : self.edges[k + 1]] for k in at]
        short, long = lists[: len(lists) - least + 1], lists[len(lists) - least + 1 :]
        met = np.sort(np.concatenate(short), kind="stable")
        met = met[np.searchsorted(met, low) : np.searchsorted(met, high)]
        heads = np.flatnonzero(np.append(True, met[1:] != met[:-1])) if len(met) else np.zeros(0, np.int64)
        candidates, counts = met[heads], np.diff(np.append(heads, len(met)))
        wanted = needed(size, self.sizes[candidates])
        for k, probed in enumerate(long):
            still = np.flatnonzero((counts < wanted) & (counts + len(long) - k >= wanted))
            if not len(still):
                break
            place = np.minimum(np.searchsorted(probed, candidates[still]), len(probed) - 1)
            counts[still] += probed[place] == candidates[still]
        return candidates[counts >= wanted]


def counted_links(
    sizes: np.ndarray, sets: list[np.ndarray], weights: np.ndarray, left: np.ndarray | None = None
) -> tuple[np.ndarray, DisjointSets]:
    """(weight of the sets each set is linked to, the components of these links).

    With ``left``, a mask, only pairs of one set inside and one outside it count.
    """
    found, joined = np.zeros(len(sets), np.int64), DisjointSets(len(sets))
    indexed = np.arange(len(sets)) if left is None else np.flatnonzero(left)
    lists = Lists(sizes[indexed], [sets[i] for i in indexed])
    names = indexed[lists.order]
    asked = enumerate(names) if left is None else ((None, i) for i in np.flatnonzero(~left))
    for below, i in asked:
        others = names[lists.linked(int(sizes[i]), sets[i], below)]
        if len(others):
            found[i] += weights[others].sum()
            found[others] += weights[i]
            for j in others:
                joined.join(int(i), int(j))
    return found, joined


def _counted(table: pa.Table) -> pa.Table:
    """(digest, links, least): per class its links and the smallest class it is joined with, of one block or pair of bins."""
    clusters: dict[int, list[tuple]] = {}
    for row in zip(*(table[c].to_pylist() for c in ("cluster", "digest", "n", "hashes", "weight", "side")), strict=True):
        clusters.setdefault(row[0], []).append(row[1:])
    out: list[tuple[int, int, int]] = []
    for rows in clusters.values():
        side = np.array([r[4] for r in rows])
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        links, joined = counted_links(np.array([r[1] for r in rows]), sets, np.array([r[3] for r in rows]), None if (side == 2).all() else side == 0)
        least: dict[int, int] = {}
        for i, r in enumerate(rows):
            least[joined.top(i)] = min(r[0], least.get(joined.top(i), r[0]))
        out += [(r[0], int(links[i]), least[joined.top(i)]) for i, r in enumerate(rows)]
    return pa.table({c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate(("digest", "links", "least"))})


def class_links(members: DataFrame) -> DataFrame:
    """(digest, links, least) of ``members`` (cluster, digest, n, hashes, weight), written.

    ``links`` adds up the weights of the classes a class is linked with, over all rows of its digest; ``least`` is, in
    each row, a class it is joined with directly or over others. Classes without a link come too.
    """
    costed = members.withColumn("cost", F.col("n") + SET_COST)
    sums = costed.groupBy("cluster").agg(F.sum("cost").alias("all"))
    sized = written(costed.join(sums, "cluster"), "sized")
    total = sized.agg(F.coalesce(F.sum("cost"), F.lit(0))).first()[0]
    columns = ["cluster", "digest", "n", "hashes", "weight"]
    blocks = max(1, -(-total // BIN))
    block = F.pmod(F.xxhash64("cluster"), F.lit(blocks)).cast("long")
    whole = sized.where(F.col("all") <= BIN).select(F.lit(-1).cast("long").alias("c"), block.alias("x"), block.alias("y"), *columns, F.lit(2).alias("side"))
    large = sized.where(F.col("all") > BIN)
    if large.isEmpty():
        return written(whole.repartition(blocks, "x").groupBy("x").applyInArrow(_counted, _COUNTED), "link-counts")
    order = ["n", "digest"]
    narrow = large.select("cluster", *order, "cost")
    placed = with_running_sum(narrow, ["cluster"], order, "cost", "upto", find_cuts(narrow, ["cluster"], order, WINDOW_ROWS))
    placed = written(placed.select("cluster", "digest", "n", F.floor((F.col("upto") - 1) / BIN).cast("long").alias("bin")), "bins")
    ranges = placed.groupBy("cluster", "bin").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    x, y = (ranges.select("cluster", F.col("bin").alias(b), F.col("low").alias(f"low_{b}"), F.col("high").alias(f"high_{b}")) for b in "xy")
    fits = (F.col("x") <= F.col("y")) & (F.ceil(F.col("low_y") * PERCENT / 100) <= F.col("high_x"))
    pairs = written(x.join(y, "cluster").where(fits).select(F.col("cluster").alias("c"), "x", "y"), "bin-pairs")
    same = F.col("x") == F.col("y")
    sides = pairs.select("c", "x", "y", F.col("x").alias("bin"), F.when(same, 2).otherwise(0).alias("side")).union(
        pairs.where(~same).select("c", "x", "y", F.col("y").alias("bin"), F.lit(1).alias("side"))
    )
    binned = large.join(placed.select(F.col("digest").alias("_of"), "bin"), F.col("digest") == F.col("_of")).drop("_of")
    met = binned.withColumnRenamed("bin", "_bin").join(sides, (F.col("cluster") == F.col("c")) & (F.col("_bin") == F.col("bin")))
    dealt = whole.unionByName(met.select("c", "x", "y", *columns, "side"))
    # a fixed number of partitions, as few rows may hold much work
    tasks = min(blocks + pairs.count(), 20_000)
    return written(dealt.repartition(tasks, "c", "x", "y").groupBy("c", "x", "y").applyInArrow(_counted, _COUNTED), "link-counts")


_COUNTED = "digest long, links long, least long"
