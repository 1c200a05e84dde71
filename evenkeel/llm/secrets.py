"""Secret scans: known forms, and sliding-window entropy over candidate strings. SQL functions only.

A candidate is a run of at least ``WINDOW`` letters, digits and + / _ = -. Its character class sets the threshold of
the Shannon entropy a window must reach: what all but ``MISSED`` of the windows of random keys of that class reach. Along a candidate the counts of its characters change by one in and one
out for each step, and with them the sum of n log n that gives the entropy. Windows over the threshold that touch or
overlap are one span. Candidates that an allow-list pattern matches as a whole are suppressed, and so are entropy
spans inside a known form; known forms always stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import spans

#: The known forms and the least length of what they must hold.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"
ASSIGNED_LEAST = 6

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Share of the random windows of a class that may stay under its threshold.
MISSED = 0.01


def random_windows(letters: int) -> list[tuple[float, float]]:
    """(bits, probability) of windows of ``WINDOW`` random characters out of ``letters``, each partition of the window once."""

    def partitions(rest: int, most: int):
        if rest == 0:
            yield []
        for first in range(min(rest, most), 0, -1):
            for others in partitions(rest - first, first):
                yield [first, *others]

    out = []
    for counts in partitions(WINDOW, WINDOW):
        if len(counts) <= letters:
            ways = math.perm(letters, len(counts)) * math.factorial(WINDOW)
            for n in counts:
                ways //= math.factorial(n)
            for n in set(counts):
                ways //= math.factorial(counts.count(n))
            out.append((math.log2(WINDOW) - sum(n * math.log2(n) for n in counts) / WINDOW, ways / letters**WINDOW))
    return sorted(out)


def least_bits(letters: int) -> float:
    """The most bits, cut to two places, under which at most ``MISSED`` of the random windows over ``letters`` stay."""
    below = 0.0
    for bits, share in random_windows(letters):
        below += share
        if below > MISSED:
            return math.floor(bits * 100) / 100
    return 0.0


#: Class of a whole candidate, first that fits, and the bits a window must reach.
CLASSES = [
    ("[0-9a-f]+|[0-9A-F]+", least_bits(16)), ("[A-Z0-9]+|[a-z0-9]+", least_bits(36)), ("[A-Za-z0-9]+", least_bits(62)), (".*", least_bits(64)),
]
#: Candidates that are no secrets: words, numbers, identifiers of the usual form, rules of one character.
ALLOWED = ["[A-Za-z_=/+-]+", "[0-9_=/+-]+", "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "(.)\\1*"]

_ENTROPY_STATE = "struct<n:array<int>,s:double,first:int,last:int,found:array<struct<first:int,last:int>>>"


def _entropy_spans(value: Column, letters: Column, different: Column, least: Column) -> Column:
    """(first, last) of the stretches of ``value`` whose windows reach ``least`` bits, end exclusive.

    ``letters`` are its characters and ``different`` the distinct ones, one counter each.
    """
    weight = lambda n: F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))

    def grown(state: Column, t: Column) -> Column:
        enters = F.array_position(different, F.get(letters, t)).cast("int") - 1
        leaves = F.when(t >= WINDOW, F.array_position(different, F.get(letters, t - WINDOW)).cast("int") - 1).otherwise(F.lit(-1))
        n_in, n_out = F.get(state["n"], enters), F.get(state["n"], leaves)
        change = F.when(
            enters == leaves, F.lit(0.0)
        ).otherwise(
            weight(n_in + 1) - weight(n_in) + F.when(leaves >= 0, weight(n_out - 1) - weight(n_out)).otherwise(F.lit(0.0))
        )
        counts = F.transform(state["n"], lambda n, i: n + (i == enters).cast("int") - (i == leaves).cast("int"))
        return F.struct(counts.alias("n"), (state["s"] + change).alias("s"), state["first"].alias("first"), state["last"].alias("last"), state["found"].alias("found"))

    def marked(state: Column, t: Column) -> Column:
        high = (t >= WINDOW - 1) & (F.log2(F.lit(float(WINDOW))) - state["s"] / WINDOW >= least)
        first, touches = t - (WINDOW - 1), t - (WINDOW - 1) <= state["last"]
        closed = F.concat(state["found"], F.array(F.struct(state["first"].alias("first"), state["last"].alias("last"))))
        return F.struct(
            state["n"].alias("n"), state["s"].alias("s"),
            F.when(high & ~touches, first).otherwise(state["first"]).alias("first"), F.when(high, t + 1).otherwise(state["last"]).alias("last"),
            F.when(high & ~touches & (state["last"] >= 0), closed).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(
        F.transform(different, lambda _: F.lit(0)).alias("n"), F.lit(0.0).alias("s"), F.lit(-1).alias("first"), F.lit(-1).alias("last"),
        F.array().cast("array<struct<first:int,last:int>>").alias("found"),
    ).cast(_ENTROPY_STATE)
    end = lambda s: F.when(s["last"] >= 0, F.concat(s["found"], F.array(F.struct(s["first"].alias("first"), s["last"].alias("last"))))).otherwise(s["found"])
    steps = F.sequence(F.lit(0), F.char_length(value) - 1)
    moved = F.aggregate(steps, start, lambda state, t: marked(grown(state, t).cast(_ENTROPY_STATE), t).cast(_ENTROPY_STATE), end)
    return F.when(F.char_length(value) >= WINDOW, moved).otherwise(F.array().cast("array<struct<first:int,last:int>>"))


def secrets(documents: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """(doc_id, text, assign, access, hex, entropy) for each row of ``documents`` (doc_id, text): arrays of
    (start, end, value).

    NULL and empty texts have none. Rows are scanned one by one, so NULL and repeated ids keep their rows; nothing
    is shuffled. ``allowed`` replaces the allow-list of candidates. Other columns are left out.
    """
    df = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = spans.with_spans(df, "assign", ASSIGN)
    df = spans.kept(df, "assign", lambda v: F.char_length(F.regexp_extract(v, ASSIGN, 1)) >= ASSIGNED_LEAST)
    df = spans.with_spans(df, "access", ACCESS, F.contains("text", F.lit("AKIA")))
    df = spans.with_spans(df, "hex", HEX)
    df = spans.with_spans(df, "candidate", CANDIDATE)
    whole = [f"^(?:{p})$" for p in (ALLOWED if allowed is None else allowed)]

    def suspicious(v: Column) -> Column:
        bad = F.lit(True)
        for p in whole:
            bad = bad & ~v.rlike(p)
        return bad

    df = spans.kept(df, "candidate", suspicious)

    def least(v: Column) -> Column:
        bits = F.lit(CLASSES[-1][1])
        for p, b in reversed(CLASSES[:-1]):
            bits = F.when(v.rlike(f"^(?:{p})$"), F.lit(b)).otherwise(bits)
        return bits

    parts = F.transform(
        "candidate",
        lambda c: F.struct(
            c["start"].alias("start"), c["value"].alias("value"), F.split(c["value"], "").alias("letters"),
            F.array_distinct(F.split(c["value"], "")).alias("different"), least(c["value"]).alias("least"),
        ),
    )
    df = df.withColumn("parts", F.when(F.size("candidate") > 0, parts))
    high = F.flatten(
        F.transform(
            "parts",
            lambda c: F.transform(
                _entropy_spans(c["value"], c["letters"], c["different"], c["least"]),
                lambda s: F.struct(
                    (c["start"] + s["first"]).alias("start"), (c["start"] + s["last"]).alias("end"),
                    F.substring(c["value"], s["first"] + 1, s["last"] - s["first"]).alias("value"),
                ),
            ),
        )
    )
    known = F.concat("assign", "access", "hex")
    df = df.withColumn("entropy", F.when(F.size("parts") > 0, high).otherwise(spans.none()))
    df = df.withColumn("known", known)
    outside = F.filter("entropy", lambda e: ~F.exists("known", lambda k: (k["start"] <= e["start"]) & (k["end"] >= e["end"])))
    return df.withColumn("entropy", F.when(F.size("entropy") > 0, outside).otherwise(F.col("entropy"))).select(
        "doc_id", "text", "assign", "access", "hex", "entropy"
    )


def redact(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """(doc_id, text, n_secrets) with every span of ``secrets`` replaced by ``mark``; NULL texts become empty."""
    df = secrets(documents).withColumn("all", F.array_sort(spans.labelled(["assign", "access", "hex", "entropy"])))
    return df.select("doc_id", spans.replaced(F.col("text"), F.col("all"), lambda _: F.lit(mark)).alias("text"), F.size("all").alias("n_secrets"))
