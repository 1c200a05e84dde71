"""Masks against a plain Feistel network, and what must hold of any permutation of a shape."""

import hashlib

from pyspark.sql import functions as F

from evenkeel.functions.masking import BLOCK, CLASSES, ROUNDS, mask, unmask


def expected(text, key, domain=""):
    a, b = text[: len(text) // 2], text[len(text) // 2 :]
    for turn in range(ROUNDS):
        out = ""
        for i, c in enumerate(a):
            digest = hashlib.sha256(f"{key}:{domain}:{turn}:{i // BLOCK}:{b}".encode()).hexdigest()
            shift = int(digest[i % BLOCK * 8 : i % BLOCK * 8 + 8], 16)
            out += next((chr((ord(c) - f + shift) % n + f) for f, n in CLASSES if f <= ord(c) < f + n), c)
        a, b = b, out
    return a + b


TEXTS = ["", "7", "42", "Customer#000000012", "a-B-9", "größe 😀 12", "+49 (30) 555-0199", "x" * 100 + "9" * 57, "....", "0007", "7000"]


def test_masks_equal_the_plain_network_and_come_back(spark):
    frame = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string").repartition(3)
    rows = frame.select("t", mask(F.col("t"), "k1", "d").alias("m")).select("t", "m", unmask(F.col("m"), "k1", "d").alias("back")).collect()
    for r in rows:
        assert r.back == r.t
        assert r.m == (None if r.t is None else expected(r.t, "k1", "d"))


def test_masking_permutes_a_shape_and_depends_on_key_and_domain(spark):
    every = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("t"))
    masks = every.select(mask(F.col("t"), "a").alias("a"), mask(F.col("t"), "b").alias("b"), mask(F.col("t"), "a", "d").alias("d"))
    row = masks.agg(
        *[F.count_distinct(c).alias(c) for c in "abd"], F.count_if(F.col("a").rlike("^[0-9]{3}$")).alias("shape"),
        F.count_if(F.col("a") == F.col("b")).alias("ab"), F.count_if(F.col("a") == F.col("d")).alias("ad"),
    ).first()
    assert (row.a, row.b, row.d, row["shape"]) == (1000, 1000, 1000, 1000)
    assert max(row.ab, row.ad) < 20


def test_numbers_join_after_masking(spark):
    one = spark.createDataFrame([(i,) for i in (1, 2, 2, 30, 400, None)], "k long")
    other = spark.createDataFrame([(i,) for i in (2, 30, 31, None)], "j int")
    plain = one.join(other, F.col("k") == F.col("j")).count()
    masked = one.select(mask(F.col("k"), "s").alias("k")).join(other.select(mask(F.col("j"), "s").alias("j")), F.col("k") == F.col("j"))
    assert masked.count() == plain == 3
