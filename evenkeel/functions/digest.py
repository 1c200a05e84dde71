"""Row hashes as integer limbs that plain long sums can fold.

Spark has no 256-bit integer. A SHA-256 is cut into sixteen 16-bit limbs whose sums stay
exact in a long up to 2**47 rows; the carries are resolved once, on the folded row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import FLOAT_DECIMALS, fast_row_text, row_text

WORDS = range(4)
LIMBS = range(4)


def hash_word(hex_text: Column, position: int) -> Column:
    """64 bits of a hex digest as a signed long."""
    return F.conv(F.substring(hex_text, 16 * position + 1, 16), 16, -10).cast("long")


def prefix60(hex_text: Column) -> Column:
    """The first 15 hex digits of a digest as a non-negative long."""
    return F.conv(F.substring(hex_text, 1, 15), 16, 10).cast("long")


def key_bucket(key_text: Column, buckets: int) -> Column:
    return F.pmod(prefix60(F.md5(key_text)), F.lit(buckets))


def exact_row_hash(
    df: DataFrame,
    columns: Sequence[str],
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
) -> Column:
    return F.sha2(row_text(df, columns, decimals, numeric_strings), 256)


def fast_row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.md5(fast_row_text(df, columns))


def sum60(value: str, name: str, condition: str | None = None) -> list[Column]:
    """Three 20-bit limb sums of a 60-bit column, exact up to 2**43 rows."""
    filtered = f" FILTER (WHERE {condition})" if condition else ""
    return [
        F.expr(f"coalesce(sum(shiftright({value}, {shift}) & 1048575){filtered}, 0L) AS {name}{i}")
        for i, shift in enumerate((40, 20, 0))
    ]


def join60(name: str) -> Column:
    """The sum whose limbs ``sum60`` folded, as decimal(38,0)."""
    terms = [f"cast({name}{i} AS decimal(38,0)) * {1 << shift}BD" for i, shift in enumerate((40, 20, 0))]
    return F.expr(f"cast({' + '.join(terms)} AS decimal(38,0))")


def _fold256(hashes: DataFrame) -> DataFrame:
    """Fold a ``hash`` column of SHA-256 texts into count, limb sums and word xors."""
    words = hashes.select(*[hash_word(F.col("hash"), w).alias(f"w{w}") for w in WORDS])
    folds = ["count(1) AS row_count"]
    for w in WORDS:
        folds.append(f"coalesce(bit_xor(w{w}), 0L) AS x{w}")
        for i in LIMBS:
            folds.append(f"coalesce(sum(shiftrightunsigned(w{w}, {48 - 16 * i}) & 65535L), 0L) AS s{w}_{i}")
    return words.agg(*[F.expr(f) for f in folds])


def _carried() -> Column:
    """The 16 limb sums as one number modulo 2**256, in 64 hex digits."""
    limbs = ", ".join(f"s{w}_{i}" for w in reversed(WORDS) for i in reversed(LIMBS))
    return F.expr(
        f"""aggregate(
            array({limbs}),
            named_struct('carry', 0L, 'digits', ''),
            (acc, limb) -> named_struct(
                'carry', shiftright(acc.carry + limb, 16),
                'digits', concat(lpad(lower(hex((acc.carry + limb) & 65535L)), 4, '0'), acc.digits)),
            acc -> acc.digits)"""
    )


def fingerprint(hashes: DataFrame) -> DataFrame:
    """One row (row_count, sum_hex, xor_hex, digest) for a frame with a ``hash`` column.

    Sum is taken modulo 2**256, so duplicates stay visible; xor guards equal sums. The
    digest is the SHA-256 of ``count:sum:xor`` in hex without leading zeros.
    """
    folded = _fold256(hashes)
    xor_hex = F.expr("lower(concat(" + ", ".join(f"lpad(hex(x{w}), 16, '0')" for w in WORDS) + "))")
    shown = folded.select("row_count", _carried().alias("sum_hex"), xor_hex.alias("xor_hex"))
    short = [F.regexp_replace(F.col(c), "^0+(?=.)", "") for c in ("sum_hex", "xor_hex")]
    digest = F.sha2(F.concat_ws(":", F.col("row_count").cast("string"), *short), 256)
    return shown.withColumn("digest", digest)


def exact_fingerprint(
    df: DataFrame,
    columns: Sequence[str],
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
) -> DataFrame:
    return fingerprint(df.select(exact_row_hash(df, columns, decimals, numeric_strings).alias("hash")))


def fast_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (row_count, hash_sum): count and sum of the 60-bit MD5 prefixes."""
    rows = df.select(prefix60(fast_row_hash(df, columns)).alias("h"))
    folded = rows.agg(F.count(F.lit(1)).alias("row_count"), *sum60("h", "s"))
    return folded.select("row_count", join60("s").alias("hash_sum"))


def bucket_fingerprints(df: DataFrame, key: Column, columns: Sequence[str], buckets: int = 256) -> DataFrame:
    """(bucket, row_count, hash_sum) per hash bucket of the key."""
    rows = df.select(
        key_bucket(key.cast("string"), buckets).alias("bucket"), prefix60(fast_row_hash(df, columns)).alias("h")
    )
    folded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), *sum60("h", "s"))
    return folded.select("bucket", "row_count", join60("s").alias("hash_sum"))
