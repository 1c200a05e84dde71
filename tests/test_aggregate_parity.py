"""Aggregate verdicts with many columns, each under its own tolerance."""

import datetime
import time
from decimal import Decimal

from pyspark.sql import functions as F

from evenkeel.operators.parity import Aggregate, aggregate_parity

ROWS = "k int, amount decimal(38,20), share double, name string, at timestamp, nothing int"


def side(spark, amount, share, name, second):
    at = datetime.datetime(2024, 3, 1, 12, 0, second)
    return spark.createDataFrame([(1, amount, share, name, at, None), (2, amount, share, "b", at, None)], ROWS)


def verdicts(spark, source, target, aggregates):
    return {r.target: r.status for r in aggregate_parity("t", source, target, aggregates).collect()}


def test_each_column_has_its_own_tolerance(spark):
    source = side(spark, Decimal("1.00000000000000000001"), 100.0, "10", 0)
    target = side(spark, Decimal("1.00000000000000000002"), 101.0, "10.0", 5)
    found = verdicts(spark, source, target, [
        Aggregate("k", "sum"), Aggregate("amount", "max"), Aggregate("amount", "min", "0.1%"), Aggregate("share", "max", "0.5%"),
        Aggregate("share", "min", "1%"), Aggregate("share", "sum", 2), Aggregate("name", "min"), Aggregate("at", "max", 4),
        Aggregate("at", "min", 5), Aggregate("at", "count"), Aggregate("nothing", "max"),
    ])
    assert found == {
        "t.k:sum": "PASS", "t.amount:max": "FAIL", "t.amount:min": "PASS", "t.share:max": "FAIL", "t.share:min": "PASS",
        "t.share:sum": "PASS", "t.name:min": "PASS", "t.at:max": "FAIL", "t.at:min": "PASS", "t.at:count": "PASS",
        "t.nothing:max": "PASS",
    }


def test_a_share_of_an_instant_means_equality_and_empty_sides_agree_only_with_each_other(spark):
    source, target = side(spark, Decimal(1), 1.0, "a", 0), side(spark, Decimal(1), 1.0, "a", 5)
    asked = [Aggregate("at", "max", "50%"), Aggregate("share", "max", "50%")]
    assert verdicts(spark, source, target, asked) == {"t.at:max": "FAIL", "t.share:max": "PASS"}
    assert set(verdicts(spark, source, target.limit(0), asked).values()) == {"FAIL"}
    assert set(verdicts(spark, source.limit(0), target.limit(0), asked).values()) == {"PASS"}


def test_planning_does_not_grow_with_the_square_of_the_columns(spark):
    wide = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(150)])
    began = time.monotonic()
    frame = aggregate_parity("w", wide, wide, [Aggregate(f"c{i}", "sum", f"{i}%") for i in range(150)])
    assert time.monotonic() - began < 20
    assert frame.where("status = 'PASS'").count() == 150
