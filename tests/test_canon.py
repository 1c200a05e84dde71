"""Canonical text and digests: fixed pairs of value and text, and properties."""

import datetime
import hashlib
from decimal import Decimal

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import digest
from evenkeel.functions.canon import NULL_TOKEN, canonical, column, fast_row_text, row_text

quick = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate])
D, DAY, AT = Decimal, datetime.date, datetime.datetime

# type, value, its text
PAIRS = [
    ("bigint", None, "\x00__NULL__\x00"), ("bigint", -(2**63), "-9223372036854775808"), ("int", 7, "7"),
    ("boolean", True, "true"), ("boolean", False, "false"),
    ("double", float("nan"), "\x00NaN\x00"), ("double", float("inf"), "\x00Inf\x00"), ("double", float("-inf"), "\x00-Inf\x00"),
    ("double", -0.0, "0"), ("double", 1.5, "1.5"), ("double", 1e-7, "0"), ("double", 4.9999995, "5"), ("double", -2.0000005, "-2.000001"),
    ("double", 0.001, "0.001"), ("double", 1e7, "10000000"), ("double", 123456789.125, "123456789.125"), ("double", 2e32, "2" + "0" * 32),
    ("double", 1e40, "1" + "0" * 40), ("double", 4.8751249856483e17, "487512498564830000"), ("double", 1234567.8912345, "1234567.891235"),
    ("decimal(20,6)", D("1.500000"), "1.5"), ("decimal(20,6)", D("-0.000000"), "0"), ("decimal(20,6)", D("100"), "100"), ("decimal(38,0)", D("-12000"), "-12000"),
    ("string", "1.50", "1.50"), ("string", "", ""), ("string", "é\n", "é\n"), ("binary", b"\x00\xff", "00ff"), ("binary", b"", ""),
    ("date", DAY(1600, 1, 1), "1600-01-01"), ("timestamp_ntz", AT(2024, 1, 2, 3, 4, 5, 999999), "2024-01-02 03:04:05"),
    ("array<double>", [1.0, None, 0.25], "[1,\x00__NULL__\x00,0.25]"), ("array<double>", [], "[]"),
    ("map<string,bigint>", {"b": 2, "a": None}, "{a:\x00__NULL__\x00,b:2}"), ("map<string,bigint>", {}, "{}"),
    ("struct<z:bigint,a:string>", (1, None), "{a:\x00__NULL__\x00,z:1}"), ("struct<z:bigint,a:string>", None, "\x00__NULL__\x00"),
]


def text_of(spark, kind, values, **options):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)
    return [r[0] for r in df.select(canonical(column("v"), df.schema["v"].dataType, **options)).collect()]


@pytest.mark.parametrize("kind", dict.fromkeys(k for k, _, _ in PAIRS))
def test_fixed_texts(spark, kind):
    mine = [(v, t) for k, v, t in PAIRS if k == kind]
    assert text_of(spark, kind, [v for v, _ in mine]) == [t for _, t in mine]


@quick
@given(st.lists(st.decimals(-(10**9), 10**9, places=4), min_size=10, max_size=30))
def test_equal_numbers_have_equal_texts_in_every_type(spark, numbers):
    as_text = text_of(spark, "string", [f"{n:.6f}" for n in numbers], numeric_strings=True)
    assert text_of(spark, "decimal(30,4)", numbers) == text_of(spark, "decimal(38,12)", numbers) == as_text
    assert text_of(spark, "double", [float(n) for n in numbers]) == as_text
    assert [Decimal(t) for t in as_text] == numbers


@quick
@given(st.lists(st.integers(-(10**20), 10**20) | st.none(), max_size=30), st.integers(1, 7))
def test_digest_ignores_order_and_partitions_but_not_copies(spark, values, parts):
    frame = lambda v: spark.createDataFrame([(x if x is None else Decimal(x), "s") for x in v], "v decimal(38,0), s string")
    one = digest.exact_fingerprint(frame(values), ["v", "s"]).first()
    assert one == digest.exact_fingerprint(frame(values[::-1]).repartition(parts), ["v", "s"]).first()
    assert one.row_count == len(values)
    assert one.digest != digest.exact_fingerprint(frame([*values, 5]), ["v", "s"]).first().digest


@pytest.mark.parametrize("values", [[3], [1, 1, 2], list(range(-40, 40))])
def test_fingerprint_is_the_sum_and_xor_of_hashes(spark, values):
    got = digest.exact_fingerprint(spark.createDataFrame([(v, None) for v in values], "a bigint, b string").repartition(3), ["a", "b"]).first()
    hashes = [int.from_bytes(hashlib.sha256(f"{v}\x1f{NULL_TOKEN}".encode()).digest(), "big") for v in values]
    total, xor = sum(hashes) % 2**256, 0
    for h in hashes:
        xor ^= h
    assert (got.sum_hex, got.xor_hex) == (f"{total:064x}", f"{xor:064x}")
    assert got.digest == hashlib.sha256(f"{len(values)}:{total:x}:{xor:x}".encode()).hexdigest()


def test_numeric_strings_meet_numbers_digit_for_digit(spark):
    pairs = {
        "1.50": "1.5", "  1.5 ": "1.5", "\t1.50\n": "1.5", "+007": "7", "-0.0": "0", ".5": "0.5", "5.": "5", "1e3": "1000", "-1.20E-2": "-0.012",
        "1e-20": "0." + "0" * 19 + "1", "9e-20": "0." + "0" * 19 + "9", "1e25": "1" + "0" * 25, "0e5": "0", "12.5e1": "125", "12.50e0": "12.5",
        "12345678901234567890123456789012345678901.10": "12345678901234567890123456789012345678901.1",
        "abc": "abc", "": "", "e5": "e5", "1e": "1e", "1e99999": "1e99999", "1 2": "1 2", ".": ".",
    }
    assert text_of(spark, "string", list(pairs), numeric_strings=True) == list(pairs.values())


def test_instants_read_the_same_in_every_zone(spark):
    df = spark.sql("SELECT timestamp_micros(1704164645999999) AS at UNION ALL SELECT timestamp_micros(-1)")
    before = [r[0] for r in df.select(canonical(F.col("at"), T.TimestampType())).collect()]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r[0] for r in df.select(canonical(F.col("at"), T.TimestampType())).collect()] == before == ["2024-01-02 03:04:05", "1969-12-31 23:59:59"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_column_counts_as_null(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    both = df.select(row_text(df, ["a", "b"]).alias("x"), row_text(df, ["a", "zz"]).alias("y")).first()
    assert both.x == both.y


def test_fast_text(spark):
    df = spark.createDataFrame(
        [(Decimal("-0.50"), 1.5, True, None, datetime.datetime(2024, 1, 2, 3, 4, 5, 999999))],
        "d decimal(12,2), f double, t boolean, s string, at timestamp_ntz",
    )
    assert df.select(fast_row_text(df, df.columns)).first()[0] == "-500000000~|~1500000~|~true~|~__NULL__~|~2024-01-02 03:04:05"


def test_fast_fingerprint_sums_prefixes(spark):
    df = spark.range(1000).repartition(7)
    total = sum(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i in range(1000))
    got = digest.fast_fingerprint(df, ["id"]).first()
    assert (got.row_count, int(got.hash_sum)) == (1000, total)
    folded = digest.bucket_fingerprints(df, F.col("id"), ["id"], 16).agg(F.sum("row_count"), F.sum("hash_sum")).first()
    assert (folded[0], int(folded[1])) == (1000, total)


def test_empty_frame_has_a_fingerprint(spark):
    got = digest.exact_fingerprint(spark.range(0), ["id"]).first()
    assert got.row_count == 0 and got.digest == hashlib.sha256(b"0:0:0").hexdigest()
