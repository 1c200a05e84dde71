"""Differences past the digits that a common decimal holds, and rows that share names or ids."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.tolerance import within
from evenkeel.operators import encoding, parity
from evenkeel.operators.intervals import followers_within
from evenkeel.sources import writers


@pytest.mark.parametrize("kind", ["decimal(30,22)", "string"])
def test_decimal_differences_past_the_eighteenth_place(spark, kind):
    value = (lambda t: t) if kind == "string" else Decimal
    frame = lambda a, b: spark.createDataFrame([(1, value(a)), (2, value(b))], f"k int, v {kind}")
    found = encoding.decimal_differences(frame("0.00000000000000000001", "1.50"), frame("0.00000000000000000009", "1.5"), ["k"], ["v"])
    assert [(r.k, r.reason) for r in found.collect()] == [(1, "value")]


def test_text_that_is_no_number(spark):
    frame = lambda *v: spark.createDataFrame(list(enumerate(v)), "k int, v string")
    found = encoding.decimal_differences(frame("x", "x", "1", None, "1e2"), frame("x", "y", "z", None, "100"), ["k"], ["v"])
    assert sorted((r.k, r.reason) for r in found.collect()) == [(1, "unparseable"), (2, "unparseable")]


@pytest.mark.parametrize(
    "a, b, tolerance, passes",
    [
        ("1.0000000001", "1.0000000004", 0, False), ("1.0000000001", "1.00000000010", 0, True), ("1.0000000001", "1.0000000004", "1e-9", True),
        ("1e30", "1000000000000000000000000000001", 0, False), ("5", "6", 1, True), ("5", "6", "10%", False), ("abc", "abc", 1, True), ("abc", "abd", 9, False),
        (None, None, 0, True), (None, "0", 5, False), ("0.12345678901234567890", "0.12345678901234567891", "1e-21", False),
    ],
)
def test_within(spark, a, b, tolerance, passes):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(within(F.col("a"), F.col("b"), tolerance)).first()[0] is passes


def test_scalar_and_aggregate_parity_see_the_tenth_place(spark):
    a, b = (spark.createDataFrame([(Decimal(x),)], "v decimal(20,10)") for x in ("1.0000000001", "1.0000000004"))
    assert parity.scalar_parity("s", a, b).first()["status"] == "FAIL"
    assert parity.aggregate_parity("t", a, b, [parity.Aggregate("v", "sum")]).first()["status"] == "FAIL"


def test_pairs_of_one_name_are_two_checks(spark):
    pairs = [parity.TablePair("t", spark.range(10), spark.range(5)), parity.TablePair("t", spark.range(5), spark.range(10))]
    assert [r["status"] for r in parity.rowcount_parity(pairs).collect()] == ["FAIL", "FAIL"]


def test_repeated_ids_keep_their_rows(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 'k', TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-02'), (1, 'k', TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-02'),
           (2, 'k', TIMESTAMP'2024-01-03', TIMESTAMP'2024-01-04'), (1, 'j', TIMESTAMP'2024-01-03', TIMESTAMP'2024-01-04') AS t(id, key, s, e)"""
    )
    found = followers_within(df, "id", "key", "s", "e", 7).collect()
    assert sorted((r.id, r.followers) for r in found) == [(1, 0), (1, 1), (1, 1), (2, 0)]


@pytest.mark.parametrize("format, bad, good", [("csv", "1,2.5\nxx,oops\n", "1,2.5\n2,3\n"), ("json", '{"id": 1}\nnot json\n', '{"id": 1}\n{"id": 2}\n')])
def test_loads_refuse_bad_records(spark, tmp_path, format, bad, good):
    for name, text, status in (("bad", bad, "FAIL"), ("good", good, "PASS")):
        (tmp_path / f"{name}.{format}").write_text(text)
        load = writers.Load(name, str(tmp_path / f"{name}.{format}"), format, str(tmp_path / f"{name}-out"), 2, schema="id int, v double")
        assert [r["status"] for r in writers.bulk_load(spark, load).collect()] == [status]
