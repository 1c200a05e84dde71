"""Jaccard join of documents on word shingles by T-occurrence search.

1. Texts with the same set of shingles are one class. A set is a sorted array of 64-bit hashes.
2. Shingles that only one class has cannot be shared. Tasks deal the sets, packed and without copies of a class, to
   buckets of the hash; a bucket finds the shingles of several classes and returns them, with the number of classes,
   to their owners. A shingle in a large share of some slice's classes is hot: hot shingles are counted beforehand,
   are a bounded number, and skip the bucket, so none gathers there. Classes with too few shared shingles to reach
   the threshold leave.
3. The rest order their shingles by rarity. Two sets with enough overlap share one of their first
   ``n - ceil(0.75 n) + 1``. Each such shingle links its classes to its smallest one; the components of these links
   are clusters, and links run only inside one.
4. Clusters are searched in blocks by merging the short inverted lists of a class and looking candidates up in the long
   ones (DivideSkip). ``near_duplicates`` finds every link and counts them for each class (``overlap``). ``keep_one``
   needs the components alone: classes already in one component are not compared again there. A cluster larger than a
   block is first joined around its smallest class, then each pair of blocks that holds several components is searched.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.arrays import mixed, packed, ranges, text_slices, unpacked, words_of
from evenkeel.llm.jaccard_rules import DisjointSets, least_overlap, needed
from evenkeel.llm.overlap import class_links
from evenkeel.llm.tables import components, written

SHINGLE = 5
#: Buckets of hashes; classes in a block; share of a slice's classes from which a shingle is reported as frequent,
#: least number of them, and share of all texts from which it is hot.
BUCKETS, BLOCK, OFTEN, OFTEN_LEAST, HOT = 48, 1500, 0.004, 4, 0.004
_HOT_COUNT = np.uint32(2**32 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text one after the other, how many each has)."""
    words, heads = words_of(data, offsets)
    counts = np.diff(heads)
    made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    out = np.zeros(int(made.sum()), np.uint64)
    text = np.repeat(np.arange(len(counts)), made)
    long = np.repeat(counts >= SHINGLE, made)
    first = ranges(heads[:-1], made)
    for k in range(SHINGLE):
        out[long] = mixed(out[long] * _STEP + words[first[long] + k])
    for t in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        whole = counts[t : t + 1].astype(np.uint64)
        for k in range(heads[t], heads[t + 1]):
            whole = mixed(whole * _STEP + words[k : k + 1])
        out[np.searchsorted(text, t)] = whole[0]
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    new = np.append(True, (out[1:] != out[:-1]) | (text[1:] != text[:-1])) if len(out) else np.zeros(0, bool)
    out, text = out[new], text[new]
    return out, np.bincount(text, minlength=len(counts)).astype(np.int64)


def set_digests(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 63-bit digest of each set; empty sets get 0."""
    ends = np.cumsum(sizes)
    inner = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
    total = np.append(np.uint64(0), np.add.accumulate(mixed(values ^ mixed(inner.astype(np.uint64) + np.uint64(1)))))
    sums = total[ends] - total[ends - sizes]
    return np.where(sizes > 0, (mixed(sums + sizes.astype(np.uint64)) >> np.uint64(1)).astype(np.int64), 0)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's id, hash of the text, set size and set digest; and, with a NULL size, the frequent shingles of each slice."""
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column(1)):
            values, sizes = shingle_sets(data, offsets)
            digests = set_digests(values, sizes)
            _, pick = np.unique(digests, return_index=True)
            one = np.zeros(len(sizes), bool)
            one[pick] = True
            own, counts = np.unique(values[np.repeat(one, sizes)], return_counts=True)
            often = counts >= max(OFTEN_LEAST, OFTEN * len(pick))
            n = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0)[first:end].cast(pa.int64()), pa.nulls(n, pa.int64())]),
                    pa.concat_arrays([batch.column(2)[first:end], pa.nulls(n, pa.int64())]),
                    pa.concat_arrays([pa.array(sizes), pa.nulls(n, pa.int64())]),
                    pa.array(np.concatenate([digests, own[often].view(np.int64)])),
                    pa.concat_arrays([pa.nulls(end - first, pa.int64()), pa.array(counts[often].astype(np.int64))]),
                ],
                ["doc_id", "same", "n_shingles", "digest", "classes"],
            )


def _dealt(hot: np.ndarray, buckets: int):
    """Sets to packed rows by bucket of the hash; hot shingles go to their owner's own bucket."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                values, sizes = shingle_sets(data, offsets)
                digests = set_digests(values, sizes)
                one = np.zeros(len(sizes), bool)
                one[np.unique(digests, return_index=True)[1]] = True
                one &= sizes > 0
                chosen = np.repeat(one, sizes)
                owner, values = np.repeat(digests, sizes)[chosen], values[chosen]
                known = hot[np.minimum(np.searchsorted(hot, values), max(len(hot) - 1, 0))] == values if len(hot) else np.zeros(len(values), bool)
                bucket = (values >> np.uint64(32)).astype(np.int64) * buckets >> 32
                bucket[known] = buckets + (owner[known] % buckets)
                order = np.lexsort((owner, bucket))
                edges = np.searchsorted(bucket[order], np.arange(2 * buckets + 1))
                rows = []
                for b in np.flatnonzero(np.diff(edges)):
                    at = order[edges[b] : edges[b + 1]]
                    heads = np.flatnonzero(np.append(True, np.diff(owner[at]) != 0))
                    rows.append((int(b), packed(owner[at][heads]), packed(np.diff(np.append(heads, len(at))).astype(np.uint32)), packed(values[at])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 3], strict=True)], ["bucket", "owners", "sizes", "hashes"]
                    )

    return dealt


def _shared(buckets: int):
    """A bucket's shingles of several classes, packed for each owner with their number of classes."""

    def shared(table: pa.Table) -> pa.Table:
        hot = table["bucket"][0].as_py() >= buckets
        owners, _ = unpacked(table["owners"], np.int64)
        sizes, _ = unpacked(table["sizes"], np.uint32)
        values, _ = unpacked(table["hashes"], np.uint64)
        owner = np.repeat(owners, sizes)
        order = np.lexsort((owner, values))
        owner, values = owner[order], values[order]
        new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))
        owner, values = owner[new], values[new]
        heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        many = np.diff(np.append(heads, len(values)))
        classes = np.repeat(many, many).astype(np.uint32)
        if hot:
            classes[:] = _HOT_COUNT
        keep = classes > 1
        owner, values, classes = owner[keep], values[keep], classes[keep]
        order = np.argsort(owner, kind="stable")
        owner, values, classes = owner[order], values[order], classes[order]
        heads = np.flatnonzero(np.append(True, np.diff(owner) != 0)) if len(owner) else np.zeros(0, np.int64)
        edges = np.append(heads, len(owner))
        return pa.table(
            {
                "digest": pa.array(owner[heads], pa.int64()),
                "hashes": pa.array([packed(values[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
                "classes": pa.array([packed(classes[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
            }
        )

    return shared


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that can reach the threshold: their shared shingles by rarity, and those of the prefix."""
    for batch in batches:
        out = []
        for digest, n, hashes, classes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(b"".join(hashes), np.uint64)
            rarity = np.frombuffer(b"".join(classes), np.uint32)
            if len(values) < least_overlap(n):
                continue
            values = values[np.lexsort((values, rarity))]
            first = n - least_overlap(n) + 1 - (n - len(values))
            out.append((digest, n, packed(values), values[:first].view(np.int64).tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 4, [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())], strict=True)],
            ["digest", "n", "hashes", "prefix"],
        )


def divide_skip(sizes: list[int], sets: list[np.ndarray], seen: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join every pair of sets which reaches the threshold, directly or over other sets.

    ``sizes`` count all shingles of a set, ``sets`` hold those that several sets have. ``seen`` gives each set a
    component that is known to be joined. A list holds the ranks, by size, of the sets before the one searched, so
    it only rises. The long lists are one fewer than the overlap needed: what is in none of the short lists cannot
    reach it. A set is first held against one set of each of the latest components; if all sets so far then are in
    one component with it, there is nothing left to find.
    """
    order = sorted(range(len(sets)), key=lambda i: (sizes[i], i))
    union, links = DisjointSets(len(sets)), []
    if seen is not None:
        firsts: dict[int, int] = {}
        for i, c in enumerate(seen):
            union.join(i, firsts.setdefault(c, i))
    lists: dict[int, list[int]] = {}
    heads: dict[int, set[int]] = {}  # by the top of a component, the shingles of one of its sets
    examples: dict[int, int] = {}

    def linked(i: int, j: int) -> None:
        for top in {union.top(i), union.top(j)}:
            gone, example = heads.pop(top, None), examples.pop(top, None)
            if gone is not None:
                kept = gone, example
        union.join(i, j)
        links.append((i, j))
        heads[union.top(i)], examples[union.top(i)] = kept

    for rank, i in enumerate(order):
        own = sets[i].tolist()
        shingles = set(own)
        for top in list(heads)[-3:]:
            if top not in heads:
                continue
            j = examples[top]
            if union.top(i) != top and sizes[j] >= least_overlap(sizes[i]) and len(shingles & heads[top]) >= needed(sizes[i], sizes[j]):
                linked(j, i)
        alone = not heads or (len(heads) == 1 and union.top(i) in heads)
        entries = [] if alone else [x for x in (lists.get(s) for s in own) if x]
        least = needed(sizes[i], least_overlap(sizes[i]))
        if len(entries) >= least:
            entries.sort(key=len)
            short, long = entries[: len(entries) - least + 1], entries[len(entries) - least + 1 :]
            for candidate, same in groupby(heapq.merge(*short)):
                j = order[candidate]
                if union.top(i) == union.top(j) or sizes[j] < least_overlap(sizes[i]):
                    continue
                count, want = sum(1 for _ in same), needed(sizes[i], sizes[j])
                for k, probed in enumerate(long):
                    if count >= want or count + len(long) - k < want:
                        break
                    at = bisect_left(probed, candidate)
                    count += at < len(probed) and probed[at] == candidate
                if count >= want:
                    linked(j, i)
        if union.top(i) not in heads:
            heads[union.top(i)], examples[union.top(i)] = shingles, i
        for s in own:
            lists.setdefault(s, []).append(rank)
    return links


def _searched(table: pa.Table) -> pa.Table:
    """Links between the classes of one group (cluster, digest, n, hashes, seen), cluster by cluster."""
    clusters: dict[int, list[tuple]] = {}
    for cluster, digest, n, hashes, seen in zip(*(table[c].to_pylist() for c in ("cluster", "digest", "n", "hashes", "seen")), strict=True):
        clusters.setdefault(cluster, []).append((digest, n, np.frombuffer(hashes, np.uint64), seen))
    found = []
    for rows in clusters.values():
        rows = list({r[0]: r for r in rows}.values())
        digests = [r[0] for r in rows]
        joined, least = DisjointSets(len(rows)), list(digests)
        for i, j in divide_skip([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows]):
            a, b = joined.top(i), joined.top(j)
            joined.join(a, b)
            least[joined.top(a)] = min(least[a], least[b])
        # as stars around the smallest, which the components of all groups are found from in few rounds
        found += [(least[joined.top(i)], digest) for i, digest in enumerate(digests) if least[joined.top(i)] != digest]
    return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})


_LINKS = "a long, b long"


def _links(members: DataFrame) -> DataFrame:
    """All links of ``members`` (cluster, digest, n, hashes), up to connection."""
    block, spread = BLOCK, lambda c, n: F.pmod(F.xxhash64(c), n)
    total = members.count()
    sizes = members.groupBy("cluster").agg(F.count("*").alias("members"))
    sized = members.join(sizes, "cluster").withColumn("seen", F.col("digest"))
    small = sized.where(F.col("members") <= block).select(
        F.lit(-1).cast("long").alias("g"), spread("cluster", F.lit(max(1, -(-total // block)))).alias("h"), "cluster", "digest", "n", "hashes", "seen"
    )
    blocks = F.ceil(F.col("members") / block).cast("long")
    large = sized.where(F.col("members") > block)
    # the smallest class of a large cluster is in all its blocks and joins them
    cut = large.select(
        F.col("cluster").alias("g"),
        F.explode(F.when(F.col("digest") == F.col("cluster"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(spread("digest", blocks)))).alias("h"),
        "cluster", "digest", "n", "hashes", "seen",
    )
    links = written(small.union(cut).groupBy("g", "h").applyInArrow(_searched, _LINKS), "links")
    if sizes.where(F.col("members") > block).isEmpty():
        return links
    joined = components(links)
    rest = large.join(joined, large["digest"] == joined["node"], "left").withColumn("seen", F.coalesce("component", "digest")).select("cluster", "digest", "n", "hashes", "seen")
    parts = rest.groupBy("cluster", "seen").agg(F.count("*").alias("own"))
    open_clusters = parts.groupBy("cluster").agg(
        F.count("*").alias("parts"), F.sum(F.when(F.col("own") <= block, F.col("own"))).alias("loose")
    ).where("parts > 1").select(F.col("cluster").alias("c"), "loose")
    open_clusters = written(open_clusters, "open-clusters")
    if open_clusters.isEmpty():
        return links
    binned = rest.join(parts, ["cluster", "seen"]).join(open_clusters, F.col("cluster") == F.col("c")).select(
        "cluster", "digest", "n", "hashes", "seen",
        F.when(F.col("own") > block, F.col("seen")).otherwise(F.lit(-1).cast("long")).alias("whole"),
        F.when(F.col("own") > block, spread("digest", F.ceil(F.col("own") / block).cast("long")))
        .otherwise(spread("seen", F.ceil(F.col("loose") / block).cast("long"))).alias("bin"),
    )
    binned = written(binned, "binned")
    bins = binned.select("cluster", "whole", "bin").distinct()
    left = bins.select(F.col("cluster").alias("c"), F.col("whole").alias("w1"), F.col("bin").alias("b1"))
    right = bins.select(F.col("cluster").alias("c"), F.col("whole").alias("w2"), F.col("bin").alias("b2"))
    pairs = left.join(right, "c").where("w1 < w2 or (w1 = -1 and w2 = -1 and b1 <= b2)")
    pairs = pairs.withColumn("g", F.xxhash64("c", "w1", "b1")).withColumn("h", F.xxhash64("w2", "b2"))
    sides = pairs.select("c", F.col("w1").alias("w"), F.col("b1").alias("b"), "g", "h").union(pairs.select("c", "w2", "b2", "g", "h")).distinct()
    dealt = binned.join(sides, (F.col("cluster") == F.col("c")) & (F.col("whole") == F.col("w")) & (F.col("bin") == F.col("b")))
    more = dealt.select("g", "h", "cluster", "digest", "n", "hashes", "seen").groupBy("g", "h").applyInArrow(_searched, _LINKS)
    return links.union(written(more, "more-links"))


def _grouped(documents: DataFrame, every_link: bool) -> DataFrame:
    """What ``near_duplicates`` returns, same, the hash of the text, and component, which NULL ids have too.

    Without ``every_link`` links inside a component are not looked for and n_links is NULL.
    """
    buckets = max(BUCKETS, documents.rdd.getNumPartitions())
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("same"))
    first = written(texts.mapInArrow(_classes, "doc_id long, same long, n_shingles long, digest long, classes long"), "classes")
    rows = first.where("n_shingles is not null").drop("classes")
    often = first.where("classes is not null").groupBy("digest").agg(F.sum("classes").alias("classes"))
    # at most 1 / HOT shingles per shingle of a mean text
    hot = often.where(F.col("classes") >= max(8.0, HOT * rows.count())).select("digest").collect()
    hot = np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))
    returned = (
        texts.select("text").mapInArrow(_dealt(hot, buckets), "bucket int, owners binary, sizes binary, hashes binary")
        .groupBy("bucket").applyInArrow(_shared(buckets), "digest long, hashes binary, classes binary")
    )
    sizes = rows.where("n_shingles > 0").groupBy("digest").agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("least"), F.count("*").alias("weight"))
    gathered = returned.groupBy("digest").agg(F.collect_list(F.struct("hashes", "classes")).alias("parts"))
    ordered = gathered.join(sizes.select("digest", "n"), "digest").select("digest", "n", F.col("parts.hashes").alias("hashes"), F.col("parts.classes").alias("classes"))
    ordered = written(ordered.mapInArrow(_ordered, "digest long, n long, hashes binary, prefix array<long>"), "ordered")
    prefixes = ordered.select("digest", F.explode("prefix").alias("shingle"))
    pivots = prefixes.groupBy("shingle").agg(F.min("digest").alias("pivot"))
    stars = prefixes.join(pivots, "shingle").where("digest <> pivot").select(F.col("pivot").alias("a"), F.col("digest").alias("b"))
    clusters = components(stars)
    members = ordered.drop("prefix").join(clusters, ordered["digest"] == clusters["node"]).withColumnRenamed("component", "cluster").drop("node")
    if every_link:
        counted = class_links(members.join(sizes.select("digest", "weight"), "digest"))
        joined = components(counted.where("least <> digest").select(F.col("least").alias("a"), F.col("digest").alias("b")))
        counts = counted.groupBy(F.col("digest").alias("of")).agg(F.sum("links").alias("links"))
        sizes = sizes.join(counts, sizes["digest"] == counts["of"], "left").drop("of")
    else:
        joined = components(_links(written(members, "members")))
        sizes = sizes.withColumn("links", F.lit(None).cast("long"))
    # copies of one text are linked with each other too
    own = F.coalesce("links", F.lit(0)) + F.col("weight") - 1 if every_link else F.col("links")
    classes = sizes.join(joined, sizes["digest"] == joined["node"], "left").select(
        "digest", "least", own.alias("n_links"), F.coalesce("component", "digest").alias("component")
    )
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = classes.join(least, "component").select(F.col("digest").alias("class"), "n_links", "component", "component_id")
    return rows.join(of_class, rows["digest"] == of_class["class"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0) if every_link else F.lit(None)).cast("long").alias("n_links"), "same", "component",
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of each row of ``documents`` (doc_id, text).

    A text's words are its runs without white space, A-Z lowered; its set holds its distinct runs of five words, or
    all words as one if it has fewer. Texts of Jaccard similarity 0.75 or more are linked; component_id is the
    smallest doc_id that links reach and n_links the number of other rows linked with it directly. NULL, empty and blank texts have no shingles and only themselves. Repeated
    rows are equal texts and linked. A NULL id is never the smallest, so a component of NULL ids alone has NULL.
    Other columns are left out.
    """
    return _grouped(documents, every_link=True).drop("same", "component")


def keep_one(documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, that come first in their component by id, NULL last, and hash of the
    text; of repeated rows of that id and text one stays. Rows without words are in no component: those of an id
    stay once for each text, those of no id all."""
    rows = written(_grouped(documents, every_link=False).where("n_shingles > 0").select("doc_id", "same", "component"), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    best = rows.groupBy("component").agg(F.min(place).alias("best"))
    each = rows.select("component", place.alias("place")).distinct()
    gone = each.join(best, "component").where(F.col("place") > F.col("best")).select(F.col("place.doc_id").alias("gone_id"), F.col("place.same").alias("gone_same"))
    on = documents["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(documents["text"]) == gone["gone_same"])
    rest = documents.join(gone, on, "left_anti")
    loose = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return rest.where(loose).union(rest.where(~loose).dropDuplicates(["doc_id", "text"]))
