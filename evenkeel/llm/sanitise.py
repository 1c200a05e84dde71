"""Personal data: known forms, and terms that reveal them. SQL functions only.

The known forms (mail addresses, network addresses, card and phone numbers) are the protected entities. What a term
may reveal are their values and what repeats in them: the kind, the mail domain, the first digits of a number; each is
a feature of every text that holds it. A term reveals a feature as far as the corpus says so: with n texts in all,
n(f) with the feature, n(t) with the term and n(tf) with both anywhere in them, the pointwise mutual information
log2(n n(tf) / (n(t) n(f))) is at most what the feature itself tells, log2(n / n(f)). Their quotient is the disclosure.
A pair seen in k different texts has its n(tf) lessened by the share ``CHANCE ** k``, as few texts may meet by chance.
In texts with a feature, every occurrence of a term that reveals it is removed from ``REMOVE`` on and replaced by a
general mark from ``GENERALISE`` on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import spans
from evenkeel.llm.tables import written

#: The known forms. A start is where a run begins or the match before ended, so no run is tried twice;
#: possessive parts give nothing back, which changes no match as nothing after them could use it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]

#: Least letters of a term, digits of a number's prefix, what chance takes of a pair seen in one text, thresholds.
LEAST_LETTERS, PREFIX, CHANCE, GENERALISE, REMOVE = 3, 6, 0.25, 0.9, 0.97

_ENTITIES = "array<struct<kind:int,start:int,end:int,value:string>>"
_TERMS = "array<struct<start:int,end:int,disclosure:double>>"
_NOT_LETTERS = "[^\\p{L}]+"


def _passes_luhn(value: Column) -> Column:
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")

    def weighed(d: Column, i: Column) -> Column:
        n = F.when(d == "", F.lit(0)).otherwise(d.cast("int"))
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    return F.aggregate(F.transform(digits, weighed), F.lit(0), lambda s, n: s + n) % 10 == 0


def entities(documents: DataFrame) -> DataFrame:
    """(doc_id, same, text, entities) of each row of ``documents`` (doc_id, text): its known forms.

    ``same`` is a hash of the text, which only rows with entities keep. NULL and empty texts have no entities.
    """
    df = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = spans.with_spans(df, "email", EMAIL, F.contains("text", F.lit("@")))
    df = spans.with_spans(df, "ip", IP)
    df = spans.kept(df, "ip", lambda v: v.rlike(f"^{IP_PART}(?:\\.{IP_PART}){{3}}$"))
    df = spans.with_spans(df, "card", CARD)
    df = spans.kept(df, "card", _passes_luhn)
    df = spans.with_spans(df, "phone", PHONE, F.contains("text", F.lit("+")))
    df = spans.kept(df, "phone", lambda v: F.char_length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15))

    def part(k: int, name: str) -> Column:
        of_kind = F.transform(name, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(F.size(name) > 0, of_kind).otherwise(F.array().cast(_ENTITIES)).cast(_ENTITIES)

    df = df.withColumn("entities", F.concat(*[part(k, n) for k, n in enumerate(KINDS)]))
    return df.select("doc_id", F.xxhash64("text").alias("same"), F.when(F.size("entities") > 0, F.col("text")).alias("text"), "entities")


def _terms(text: Column) -> Column:
    """The distinct terms of ``text``."""
    words = F.transform(F.split(text, _NOT_LETTERS), lambda w: F.lower(w))
    return F.array_distinct(F.filter(words, lambda w: F.char_length(w) >= LEAST_LETTERS))


def _features(entity: Column) -> Column:
    """What ``entity`` tells: its value, its kind, its domain or first digits."""
    value, kind = F.lower(entity["value"]), entity["kind"].cast("string")
    digits = F.substring(F.regexp_replace(value, "[^0-9]", ""), 1, PREFIX)
    begins = F.when(entity["kind"] == KINDS.index("email"), F.substring_index(value, "@", -1)).when(
        entity["kind"] == KINDS.index("ip"), F.substring_index(value, ".", 2)
    ).otherwise(digits)
    return F.array(F.concat_ws(":", kind, F.lit("is"), value), F.concat_ws(":", kind, F.lit("begins"), begins), kind)


def _featured(found: DataFrame) -> DataFrame:
    """(same, copies, terms, features) of each different text with entities; features are (feature, n_f).

    Features that one text alone has are in the same texts, so the first of them stands for all.
    """
    texts = found.where(F.size("entities") > 0)
    copies = texts.groupBy("same").agg(F.count("*").alias("copies"))
    told = texts.select("same", "text", F.array_distinct(F.flatten(F.transform("entities", _features))).alias("told")).dropDuplicates(["same"])
    texts = written(told.join(copies, "same").select("same", "copies", _terms(F.col("text")).alias("terms"), "told"), "featured")
    each = texts.select("same", "copies", F.explode("told").alias("feature"))
    # one row a feature; one that several texts have is met again in each of them
    counts = each.groupBy("feature").agg(F.sum("copies").alias("n_f"), F.count("*").alias("texts"), F.min("same").alias("of"))
    alone = counts.where("texts = 1").groupBy(F.col("of").alias("same")).agg(F.min(F.struct("feature", "n_f")).alias("f"))
    many = each.join(counts.where("texts > 1").select("feature", "n_f"), "feature").select("same", F.struct("feature", "n_f").alias("f"))
    features = many.union(alone.select("same", "f")).groupBy("same").agg(F.collect_list("f").alias("features"))
    return texts.drop("told").join(features, "same")


def disclosures(documents: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(feature, term, disclosure) of the terms that reach ``GENERALISE``; every text of the ``n`` of ``documents`` counts.

    ``pairs`` (feature, n_f, term, copies) has a row for each different text and feature and term in it.
    """
    met = pairs.groupBy("feature", "term").agg(F.first("n_f").alias("n_f"), F.sum("copies").alias("n_tf"), F.count("*").alias("texts"))
    # counted before the join: a semi join first would move every word of every text, not one row a word and task
    of_term = documents.select(F.explode(_terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    lessened = F.col("n_tf") * (1 - F.pow(F.lit(CHANCE), F.col("texts")))
    rows = F.lit(float(max(n, 1)))
    told, most = F.log2(rows * lessened / (F.col("n_t") * F.col("n_f"))), F.log2(rows / F.col("n_f"))
    measured = met.join(of_term, "term").withColumn("disclosure", F.when(most > 0, told / most).otherwise(F.lit(0.0)))
    return measured.where(F.col("disclosure") >= GENERALISE).select("feature", "term", "disclosure")


def _occurrences(df: DataFrame) -> DataFrame:
    """``df`` and ``found``, each place in ``text`` of a term of ``revealing`` (disclosure by term) outside ``entities``.

    Words and gaps alternate; a word that reveals nothing leaves the state's array as it is, so nothing is copied.
    """
    some = F.col("revealing").isNotNull()
    df = df.withColumn("words", F.when(some, F.regexp_extract_all("text", F.lit("\\p{L}+"), F.lit(0))))
    df = df.withColumn("gaps", F.when(some, F.split("text", "\\p{L}+", -1)))
    pairs = F.arrays_zip(F.col("words").alias("w"), F.slice("gaps", 1, F.size("words")).alias("g"))
    df = df.withColumn("steps", F.when(some & (F.size("words") > 0), F.transform(pairs, lambda p: F.struct(F.char_length(p["g"]).alias("g"), F.char_length(p["w"]).alias("n"), F.element_at("revealing", F.lower(p["w"])).alias("d")))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_TERMS).alias("found"))

    def grown(state: Column, s: Column) -> Column:
        first = state["at"] + s["g"]
        last = first + s["n"]
        one = F.array(F.struct(first.alias("start"), last.alias("end"), s["d"].alias("disclosure")))
        return F.struct(last.alias("at"), F.when(s["d"].isNull(), state["found"]).otherwise(F.concat(state["found"], one)).alias("found"))

    df = df.withColumn("found", F.when(F.col("steps").isNotNull(), F.aggregate("steps", start, grown, lambda s: s["found"])).otherwise(F.array().cast(_TERMS)))
    free = F.filter("found", lambda t: ~F.exists("entities", lambda e: (e["start"] < t["end"]) & (t["start"] < e["end"])))
    return df.withColumn("found", F.when(F.size("found") > 0, free).otherwise(F.col("found")))


def personal_data(documents: DataFrame) -> DataFrame:
    """(doc_id, same, entities, terms) of each row of ``documents`` (doc_id, text).

    terms are arrays of (start, end, disclosure) outside the entities. NULL and empty texts have none of either.
    Repeated rows get the same result again, NULL ids are ids, and other columns are left out. A text that is copied
    is one text where different texts are asked for, and counts with all its copies in the estimates.
    """
    found = written(entities(documents), "entities")
    texts = written(_featured(found), "features")
    pairs = texts.select("same", "copies", "terms", F.explode("features").alias("f")).select("same", "copies", "f.feature", "f.n_f", F.explode("terms").alias("term"))
    revealing = written(disclosures(documents, pairs, found.count()), "disclosures")
    hits = pairs.join(revealing, ["feature", "term"]).groupBy("same", "term").agg(F.max("disclosure").alias("disclosure"))
    of_text = hits.groupBy("same").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("revealing"))
    # texts without entities need no partner
    with_some = _occurrences(found.where(F.size("entities") > 0).join(of_text, "same", "left")).select("doc_id", "same", "entities", F.col("found").alias("terms"))
    return with_some.union(found.where(F.size("entities") == 0).select("doc_id", "same", "entities", F.array().cast(_TERMS)))


def sanitise(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with entities replaced by the mark of their kind, revealing terms by ``[TERM]`` or nothing."""
    kept = personal_data(documents)
    marks = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), e["kind"] + 1).alias("put")))
    marks = F.concat(marks, F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["disclosure"] >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]")).alias("put"))))
    kept = kept.select(F.col("doc_id").alias("id"), F.col("same").alias("key"), F.array_sort(marks).alias("marks")).distinct()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("same", F.xxhash64("text"))
    joined = texts.join(kept, texts["doc_id"].eqNullSafe(kept["id"]) & (texts["same"] == kept["key"]))
    return joined.select("doc_id", spans.replaced(F.col("text"), F.col("marks"), lambda s: s["put"]).alias("text"))
