"""Line dedup by an exact set-similarity join, in SQL functions only.

A line's tokens are its runs of five words; a line of fewer words has all of them as one token, so that it goes where
it repeats exactly. Lines with the same set of tokens are one class. A line goes if an earlier line, by document and
place, has its set or one of Jaccard similarity 0.75 or more, whether that line stays or not.

Two sets of that similarity share one of the first ``n - ceil(0.75 n) + 1`` tokens under any common order. The order
is by rarity: tokens that are frequent come last, the rest follow their hashes. At first none counts as frequent, so a
line's prefix is known from the line alone, in one pass over the texts; prefixes travel as 32-bit hashes, which can only
add candidates. The prefixes of all classes are counted once. A class with a token that too many have there moves: its
whole set is read again, and tokens that are frequent in the sets of those that move come last in their order. A pair of
which one class stays shares a token of the first order that is not frequent; a pair that moves shares one of the
second. The list of frequent tokens is of bounded length; it only decides the order, so the result does not depend on
it. Classes that share a prefix token pass the length and positional filters in
pairs, first with the earliest class of each list, then, if no match came of that, with whole lists; a list of two has
no other pair. A class is told there by its first line alone. The entries also hold the parity of a set's tokens by
their last six bits: sets differ in as many tokens at least as in these bits, which drops nearly all pairs that are not
similar. Beyond about a hundred tokens the bits tell little; if many such pairs are left, their whole prefixes bound
what the sets can share. Only lines of pairs that are left are read again, and their whole sets compared. Lines that
move are read in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.tables import lowered, written

SHINGLE, PERCENT = 5, 75
#: Rows of a few numbers that are broadcast at most; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000
#: Tokens in the prefixes of more than FEW classes are frequent; FREQUENT are told at most.
FEW, FREQUENT = 64, 20_000
#: Pairs of more than LONG tokens go by their prefixes before lines are read again, if there are over LONG_PAIRS.
LONG, LONG_PAIRS = 200, 100_000
_LAST = 2**63 - 1


def _least(n: Column) -> Column:
    return F.ceil(n * PERCENT / 100).cast("int")


def _named(documents: DataFrame) -> DataFrame:
    """(doc, same, text): NULL ids are the largest id, same is a hash of the text."""
    return documents.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("same"), "text")


def _lines_of(text: str) -> Column:
    """The lines of a text, with blanks as the only white space."""
    body = F.col(text)
    for space in "\t\x0b\x0c\r":
        body = F.replace(body, F.lit(space), F.lit(" "))
    return F.split(body, "\n")


def _tokenized(each: DataFrame) -> DataFrame:
    """(doc, same, line, n, tokens) of lines (doc, same, line, l) that have a word."""
    at = ["doc", "same", "line"]
    words = each.where(F.trim("l") != "").select(*at, F.array_remove(F.split(lowered(F.col("l")), " "), "").alias("w"))
    hashes = words.select(*at, F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    shingle = lambda w, i: F.xxhash64(w, *[F.get(F.col("h"), i + j) for j in range(1, SHINGLE)])
    runs = F.transform(F.slice("h", 1, F.greatest(F.size("h") - SHINGLE + 1, F.lit(0))), shingle)
    tokens = hashes.select(*at, F.when(F.size("h") < SHINGLE, F.array(F.xxhash64("h"))).otherwise(runs).alias("t"))
    sets = tokens.select(*at, F.sort_array(F.array_distinct("t")).alias("tokens"))
    return sets.select(*at, F.size("tokens").alias("n"), "tokens")


def _short(tokens: str | Column) -> Column:
    """32-bit hashes of tokens."""
    return F.transform(tokens, lambda t: t.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def _first(tokens: str | Column) -> Column:
    """The first tokens of sets of ``n``, of which similar sets share one."""
    return F.slice(tokens, F.lit(1), F.col("n") - _least(F.col("n")) + 1)


def _bits(tokens: str) -> Column:
    """The parity of how many tokens end in each value of six bits, as 64 bits."""
    return F.expr(f"aggregate({tokens}, 0L, (a, t) -> a ^ shiftleft(1L, cast(t & 63 as int)))")


def lines(documents: DataFrame) -> DataFrame:
    """(doc, same, line, n, tokens, class) of each line that has a word; NULL ids come last, as the largest id.

    A class is named by 128 bits of hashes of its tokens.
    """
    each = _tokenized(_named(documents).select("doc", "same", F.posexplode(_lines_of("text")).alias("line", "l")))
    return each.select("*", F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b")).alias("class"))


def _beside(df: DataFrame, keys: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """``df`` joined with the written ``keys``, which are broadcast if they were counted few."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, how)


def _again(documents: DataFrame, named: DataFrame) -> DataFrame:
    """(at, n, tokens) of the lines ``at`` (doc, same, line) of written ``named``, read again from their texts."""
    wanted = written(named.groupBy("at.doc", "at.same").agg(F.collect_list("at.line").alias("wanted")), "places")
    met = _beside(_named(documents.where("text is not null")), wanted, ["doc", "same"], "inner").select("doc", "same", _lines_of("text").alias("l"), "wanted")
    some = met.select("doc", "same", F.explode(F.transform("wanted", lambda w: F.struct(w.alias("line"), F.get("l", w).alias("l")))).alias("w"))
    each = some.select("doc", "same", "w.line", "w.l").distinct()
    return _tokenized(each).select(F.struct("doc", "same", "line").alias("at"), "n", "tokens")


def _one_of(numbers: Iterable[int]) -> str:
    return f"t IN ({', '.join(map(str, numbers))})" if numbers else "(false)"


def _rarest_first(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(first, n, bits, prefix) of written ``classes`` in an order that puts last what is frequent in their ``sets`` (at, n, tokens)."""
    own = _beside(sets.withColumnRenamed("at", "first"), classes.select("first"), "first", "inner").select("first", "n", _bits("tokens").alias("bits"), _short("tokens").alias("tokens"))
    counts = own.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") > FEW)
    frequent = [r[0] for r in counts.orderBy(F.desc("k"), "token").limit(FREQUENT).select("token").collect()]
    rare, last = (F.expr(f"filter(tokens, t -> {x} {_one_of(frequent)})") for x in ("NOT", ""))
    return own.select("first", "n", "bits", _first(F.concat(rare, last)).alias("prefix"))


def _fitting(pairs: DataFrame) -> DataFrame:
    """(x, y, long) of pairs of list entries x and y of one token that pass the filters of length, place and bits.

    The first token that two similar sets share leaves enough tokens behind it in both, so entries whose places leave
    fewer do not meet: a pair needs the list of that token alone. Similar sets differ in few tokens, and in no more bits.
    """
    both = F.col("x.n") + F.col("y.n")
    fits = F.least("x.n", "y.n") >= _least(F.greatest("x.n", "y.n"))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    differ = F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits")))
    met = pairs.where((F.col("x.at") < F.col("y.at")) & fits & (left * (100 + PERCENT) >= PERCENT * both) & (differ * (100 + PERCENT) <= (100 - PERCENT) * both))
    return met.select(F.col("x.at").alias("x"), F.col("y.at").alias("y"), (both > LONG).alias("long")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("at")).union(pairs.select("y")).distinct()


def _likely(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of written ``pairs`` (x, y, long) of ``classes`` (first, n, prefix), those that can be similar, written.

    Many long ones are judged by their whole prefixes, the others by whole sets later.
    What both sets have in the prefix that ends first is in the other prefix too; behind it a set has one token less
    than the least overlap. Equal hashes of different tokens only add to what is shared.
    """
    long = pairs.where("long")
    if long.count() <= LONG_PAIRS:
        return pairs.select("x", "y")
    known = classes.select(F.col("first").alias("at"), "n", "prefix")
    own = written(_beside(known, written(_ends(long), "named"), "at", "inner"), "prefixes")
    x, y = (own.select(F.col("at").alias(c), F.col("n").alias(f"n_{c}"), F.col("prefix").alias(f"p_{c}")) for c in "xy")
    both = F.size(F.filter("p_x", lambda t: F.array_contains("p_y", t)))
    most = both + F.greatest(_least(F.col("n_x")), _least(F.col("n_y"))) - 1
    met = long.join(x, "x").join(y, "y").where(most * (100 + PERCENT) >= PERCENT * (F.col("n_x") + F.col("n_y")))
    return written(met.select("x", "y").union(pairs.where("not long").select("x", "y")), "likely-pairs")


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(at): the later ones of written ``pairs`` (x, y) whose ``sets`` are similar enough."""
    side = lambda c: _beside(sets.select(F.col("at").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"t_{c}")), pairs, c, "inner")
    both = side("x").join(side("y"), ["x", "y"]).withColumn("both", F.size(F.array_intersect("t_x", "t_y")))
    near = both.where(F.col("both") * (100 + PERCENT) >= PERCENT * (F.col("n_x") + F.col("n_y")))
    return written(near.select(F.col("y").alias("at")).distinct(), "matched")


def _lists(classes: DataFrame) -> DataFrame:
    """(token, y, k), written: the prefix entries of ``classes`` (first, n, bits, prefix) for tokens that ``k`` have, if over one."""
    counts = written(classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("k")).where("k > 1"), "tokens")
    entries = classes.select(F.col("first").alias("at"), "n", "bits", F.posexplode("prefix").alias("place", "token"))
    return written(_beside(entries, counts, "token", "inner").select("token", F.struct("at", "n", "place", "bits").alias("y"), "k"), "lists")


def _open_pairs(lists: DataFrame, first: DataFrame) -> DataFrame:
    """(x, y, long), written: the pairs of entries of ``lists`` that fit and whose later class is not in written ``first`` (at)."""
    still = _beside(lists.select("token", "y").withColumn("at", F.col("y.at")), first, "at", "left_anti").select("token", "y")
    return written(_fitting(still.join(lists.select("token", F.col("y").alias("x")), "token")), "rest-pairs")


def _matched(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(at): the first lines of those ``classes`` (first, n, bits, prefix) to which an earlier one is similar."""
    lists = _lists(classes)
    earliest = lists.groupBy("token").agg(F.min_by("y", "y.at").alias("x"))
    pairs = _likely(classes, written(_fitting(lists.select("token", "y").join(earliest, "token")), "first-pairs"))
    counts = lists.where(F.col("k") > FEW).select("token", "k").distinct().orderBy(F.desc("k"), "token")
    frequent = [r[0] for r in counts.limit(FREQUENT).collect()]
    # of the prefixes of those that move, what is frequent
    often = lists.where(F.expr(_one_of(frequent).replace("t IN", "token IN"))).groupBy(F.col("y.at").alias("first"))
    moving = written(often.agg(F.collect_list("token").alias("prefix")), "moving")
    read = written(_ends(pairs).union(moving.select("first")).distinct(), "named")
    sets = written(_again(documents, read), "sets")
    first = _verified(sets, pairs)
    # pairs of which both move
    moved = written(_rarest_first(sets, moving), "moved")
    second = _verified(sets, _likely(moved, _open_pairs(_lists(moved), first)))
    done = written(first.union(second).distinct(), "matched")
    # pairs of which one stays; those of two entries have met
    rare = lists.where("k > 2").where(F.expr(f"NOT {_one_of(frequent)}".replace("t IN", "token IN")))
    pairs = _likely(classes, _open_pairs(rare, done))
    more = written(_ends(pairs).join(read, "at", "left_anti"), "named")
    rest = _verified(sets.union(written(_again(documents, more), "sets")), pairs)
    return done.union(rest).distinct()


def later_lines(documents: DataFrame) -> DataFrame:
    """(doc, same, line) of the lines of ``documents`` (doc_id, text) that go; line counts from 0.

    doc is the id, the largest for NULL, and same a hash of the text. Rows of the same id and text are one document;
    rows of one id with different texts come in the order of that hash. NULL and empty texts have no lines.
    """
    table = written(lines(documents).select("doc", "same", "line", "n", "class", _bits("tokens").alias("bits"), _short(_first("tokens")).alias("prefix")), "lines")
    at = F.struct("doc", "same", "line")
    own = ["n", "bits", "prefix"]
    repeated = table.groupBy("class").agg(F.min("doc").alias("least"), F.count("*").alias("k")).where("k > 1")
    repeated = written(repeated.select("class", "least"), "repeated")
    # classes of one line are taken from the lines as they are; of the others, only lines of the first document are sorted
    early = _beside(table, repeated, "class", "inner").where(F.col("doc") == F.col("least"))
    heads = early.groupBy("class").agg(F.min(F.struct(at.alias("first"), *own)).alias("head"))
    heads = written(heads.select("class", "head.first", *[f"head.{c}" for c in own]), "heads")
    classes = _beside(table, repeated, "class", "left_anti").select(at.alias("first"), *own).union(heads.select("first", *own))
    if repeated.count() > BROADCAST_ROWS:
        classes = written(classes, "line-classes")
    # a copy of an earlier line goes in any case, so a match decides on the first line of its class alone
    copies = _beside(table, heads.select("class", "first"), "class", "inner").where(at != F.col("first")).select("doc", "same", "line")
    return copies.union(_matched(documents, classes).select("at.doc", "at.same", "at.line")).distinct()


def _with_removed(documents: DataFrame) -> DataFrame:
    """``documents`` and ``_removed``, the sorted numbers of the lines that go."""
    gone = later_lines(documents.select("doc_id", "text")).groupBy(F.col("doc").alias("_doc"), F.col("same").alias("_same")).agg(
        F.sort_array(F.collect_list("line")).alias("_removed")
    )
    on = (F.coalesce(documents["doc_id"], F.lit(_LAST)) == gone["_doc"]) & (F.xxhash64(documents["text"]) == gone["_same"])
    joined = documents.join(gone, on, "left").drop("_doc", "_same")
    return joined.withColumn("_removed", F.coalesce("_removed", F.array().cast("array<int>")))


def removed_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of each row of ``documents``; removed lists line numbers, joined by commas.

    NULL texts have no lines. Repeated rows get the same result again; other columns are left out.
    """
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    counted = documents.select("doc_id", F.xxhash64("text").alias("same"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"))
    gone = later_lines(documents.select("doc_id", "text")).groupBy("doc", F.col("same").alias("of")).agg(F.sort_array(F.collect_list("line")).alias("gone"))
    joined = counted.join(gone, (F.coalesce("doc_id", F.lit(_LAST)) == F.col("doc")) & (F.col("same") == F.col("of")), "left")
    gone_lines = F.coalesce("gone", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(gone_lines).cast("long").alias("n_removed"), F.array_join(gone_lines.cast("array<string>"), ",").alias("removed"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` without their later lines, all columns; rows left without a word that had one go."""
    df = _with_removed(documents)
    stay = F.filter(F.split("text", "\n"), lambda l, i: ~F.array_contains("_removed", i))
    df = df.withColumn("text", F.when(F.size("_removed") > 0, F.array_join(stay, "\n")).otherwise(F.col("text")))
    return df.where((F.size("_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).drop("_removed").select(*documents.columns)
