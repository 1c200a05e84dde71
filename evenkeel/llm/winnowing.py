"""Benchmark decontamination by winnowing, in SQL functions only.

A window of ten words has six grams of five words; its fingerprint is the smallest gram hash, the right one of
equals. Equal windows choose the same fingerprint at the same offset, so every shared span of ten words or more
shares one (6 + 5 - 1 = 10). A document keeps the fingerprints of all its windows, each position once, which is
about two in seven. A shared fingerprint is extended to the window around it and compared word by word.
Items of fewer than ten words are windows of their own length, found by the hash of the whole item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.tables import lowered, written

WINDOW, GRAM = 10, 5
_PLACE_BITS = 30

#: Fixed value: what separates words.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; NULL and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(lowered(text), F.lit("")), SEPARATORS), "")


def _hashed(parts: Column) -> Column:
    return F.transform(parts, lambda w: F.xxhash64(w))


def _with_smallest(df: DataFrame, kept: list[str]) -> DataFrame:
    """``kept``, hashes and smallest (each window's fingerprint, in order) of the words ``w``.

    Each step is a column of its own: written as one expression, a step would run anew for each element.
    """
    grams = df.select(*kept, _hashed(F.col("w")).alias("hashes")).select("*", _placed_grams(F.col("hashes"), GRAM).alias("grams"))
    return grams.select(*kept, "hashes", _smallest(F.col("grams"), WINDOW - GRAM + 1).alias("smallest"))


def _placed_grams(hashes: Column, n: int) -> Column:
    """For each ``n`` neighbours their hash in the high bits and, falling, their place in the low ones.

    The smallest of several is thus the smallest hash, and of equal hashes the one furthest right. A place
    always fits, as no string holds 2**30 words.
    """
    last = (1 << _PLACE_BITS) - 1
    gram = lambda i: F.shiftleft(F.shiftright(F.xxhash64(*[F.get(hashes, i + j) for j in range(n)]), _PLACE_BITS), _PLACE_BITS)
    placed = F.transform(F.sequence(F.lit(0), F.size(hashes) - n), lambda i: gram(i).bitwiseOR(F.lit(last) - i))
    return F.when(F.size(hashes) >= n, placed).otherwise(F.array().cast("array<long>"))


def _smallest(grams: Column, width: int) -> Column:
    """The smallest of each ``width`` neighbours."""
    least = lambda i: F.least(*[F.get(grams, i + j) for j in range(width)])
    found = F.transform(F.sequence(F.lit(0), F.size(grams) - width), least)
    return F.when(F.size(grams) >= width, found).otherwise(F.array().cast("array<long>"))


def _key_and_place(placed: Column) -> tuple[Column, Column]:
    last = (1 << _PLACE_BITS) - 1
    return F.shiftright(placed, _PLACE_BITS), (F.lit(last) - placed.bitwiseAND(F.lit(last))).cast("int")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, key, at, window) for every window of every item: its length, fingerprint, the fingerprint's
    offset in it, and its words joined by blanks."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    grams = _with_smallest(items.where(F.size("w") >= WINDOW), ["item_id", "w"])
    # not a plain column: the optimizer would filter on its size below all steps and write them into one
    smallest = F.transform("smallest", lambda x: x + 0)
    full = grams.select("item_id", "w", F.posexplode(smallest).alias("start", "placed"))
    key, place = _key_and_place(F.col("placed"))
    full = full.select("item_id", F.lit(WINDOW).alias("n"), key.alias("key"), (place - F.col("start")).alias("at"), F.array_join(F.slice("w", F.col("start") + 1, WINDOW), " ").alias("window"))
    short = items.where(F.size("w").between(1, WINDOW - 1))
    whole = F.xxhash64(F.lit("whole"), F.concat_ws(" ", _hashed(F.col("w")).cast("array<string>")))
    short = short.select("item_id", F.size("w").alias("n"), whole.alias("key"), F.lit(0).alias("at"), F.array_join("w", " ").alias("window"))
    return full.union(short)


def _document_fingerprints(hashes: Column, smallest: Column, lengths: list[int]) -> Column:
    """(n, key, place) of a document: of its windows' fingerprints, and of all runs of the short lengths."""
    found = F.transform(
        F.array_distinct(smallest),
        lambda x: F.struct(F.lit(WINDOW).alias("n"), _key_and_place(x)[0].alias("key"), _key_and_place(x)[1].alias("place")),
    )

    def runs_of(n: int) -> Column:
        whole = lambda i: F.concat_ws(" ", *[F.get(hashes, i + j).cast("string") for j in range(n)])
        found = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - n),
            lambda i: F.struct(F.lit(n).alias("n"), F.xxhash64(F.lit("whole"), whole(i)).alias("key"), i.alias("place")),
        )
        return F.when(F.size(hashes) >= n, found).otherwise(F.array().cast("array<struct<n:int,key:long,place:int>>"))

    runs = [runs_of(n) for n in lengths]
    return F.concat(found, *runs) if runs else found


def _contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What ``contamination`` returns, and same, the hash of the text."""
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("same"))
    occurring = written(item_windows(benchmark), "windows")
    windows = written(occurring.select("n", "key", "at", "window").distinct(), "distinct-windows")
    keys = written(windows.select("n", "key").distinct(), "window-keys")
    lengths = sorted(r[0] for r in keys.where(F.col("n") < WINDOW).select("n").distinct().collect())
    marks = (
        _with_smallest(docs.select("doc_id", "same", words(F.col("text")).alias("w")), ["doc_id", "same"])
        .select("doc_id", "same", F.explode(_document_fingerprints(F.col("hashes"), F.col("smallest"), lengths)).alias("f"))
        .select("doc_id", "same", "f.n", "f.key", "f.place")
    )
    near = (
        marks.join(keys, ["n", "key"], "left_semi")
        .join(windows, ["n", "key"])
        .groupBy("doc_id", "same")
        .agg(F.collect_set(F.struct((F.col("place") - F.col("at")).alias("start"), "n", "window")).alias("near"))
        .withColumnsRenamed({"doc_id": "near_id", "same": "near_same"})
    )
    w = F.col("w")
    shared = F.filter(
        F.coalesce("near", F.array().cast("array<struct<start:int,n:int,window:string>>")),
        lambda c: (c["start"] >= 0) & (c["start"] + c["n"] <= F.size(w)) & (F.array_join(F.slice(w, F.greatest(c["start"], F.lit(0)) + 1, c["n"]), " ") == c["window"]),
    )
    starts = F.array_sort(F.array_distinct(F.transform("shared", lambda c: F.struct(c["start"].alias("first"), (c["start"] + c["n"]).alias("end")))))
    none = F.array().cast("array<struct<first:int,end:int>>")
    merged = F.aggregate(
        "starts",
        none,
        lambda spans, s: F.when(
            (F.size(spans) > 0) & (F.get(spans, F.size(spans) - 1)["end"] >= s["first"]),
            F.concat(
                F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.get(spans, F.size(spans) - 1)["first"].alias("first"),
                        F.greatest(F.get(spans, F.size(spans) - 1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(spans, F.array(s))),
    )
    judged = (
        docs.join(near, docs["doc_id"].eqNullSafe(near["near_id"]) & (docs["same"] == near["near_same"]), "left")
        .select("doc_id", "same", "near", words(F.col("text")).alias("w"))
        .select("doc_id", "same", F.size(w).cast("long").alias("n_words"), shared.alias("shared"))
        .select("doc_id", "same", "n_words", F.array_distinct(F.transform("shared", lambda c: c["window"])).alias("windows"), starts.alias("starts"))
        .select("doc_id", "same", "n_words", "windows", merged.alias("hit_spans"))
    )
    judged = written(judged, "judged")
    items = (
        judged.where(F.size("windows") > 0)
        .select("doc_id", "same", "windows").distinct()
        .select("doc_id", "same", F.explode("windows").alias("window"))
        .join(occurring.select("window", "item_id").where("item_id is not null").distinct(), "window")
        .groupBy("doc_id", "same")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumnsRenamed({"doc_id": "item_doc", "same": "item_same"})
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]))
    return judged.join(items, judged["doc_id"].eqNullSafe(items["item_doc"]) & (judged["same"] == items["item_same"]), "left").select(
        "doc_id", "same", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "hit_spans",
    )


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): which of its words lie in a window of ``benchmark`` (item_id, text).

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and hit_spans, the hit places as
    array of (first, end) in words. NULL text has no words; a repeated row gets its result again, rows of one id
    with different texts are judged apart; NULL ids are ids. An item whose id is NULL hits but is not listed;
    rows of one item id are one item. Other columns are left out. Empty tables give no rows or no hits.

    Only fingerprints that the benchmark has survive a semi join; their keys are broadcast where Spark finds
    them small, and joined by a shuffle beyond that. Candidates are gathered per document, whose length bounds them.
    """
    return _contamination(documents, benchmark).drop("same")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, whose text shares no window with ``benchmark``.

    The verdict belongs to the row: rows of one id or of no id with different texts are judged apart.
    """
    found = _contamination(documents, benchmark).where("contaminated")
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("same").alias("bad_same")).distinct()
    on = documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(documents["text"]) == bad["bad_same"])
    return documents.join(bad, on, "left_anti")
