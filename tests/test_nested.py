"""Counts of bad values inside nested columns, against counts by hand."""

from evenkeel.operators.conformance import ExpectedColumn, nested_profile

SCHEMA = "a array<struct<n: string, d: array<string>>>, m map<string, string>, s struct<x: string, y: struct<z: int>>, plain string"
ROWS = [
    ([("1", ["1.5", "x", None]), None, (None, None)], {"1": "2.25", "k": None}, ("7", (None,)), "p"),
    ([("q", ["0.00000000000000000009"])], {"2": "123456789012345678901234.567"}, (None, None), None),
    ([], {}, None, "p"),
    (None, None, ("no", (3,)), "p"),
]
EXPECTED = [
    ExpectedColumn("a", "array<struct<n: bigint not null, d: array<numeric(30,2)>>>", nullable=False),
    ExpectedColumn("m", "array<struct<key: bigint, value: numeric(30,2)>>"),
    ExpectedColumn("s", "struct<X: bigint not null, y: struct<z: int not null, gone: string>>"),
    ExpectedColumn("plain", "bigint", nullable=False),
    ExpectedColumn("absent", "array<int>"),
]


def found(frame, expected):
    return {(r.column, r.rule): r.bad for r in nested_profile(frame, expected).collect()}


def test_every_level(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    assert found(frame, EXPECTED) == {
        ("a", "not_null"): 1, ("a[]", "not_null"): 1, ("a[].n", "not_null"): 1, ("a[].n", "convertible"): 1,
        ("a[].d[]", "not_null"): 1, ("a[].d[]", "convertible"): 1, ("a[].d[]", "scale"): 1,
        ("m[].key", "convertible"): 1, ("m[].value", "convertible"): 0, ("m[].value", "scale"): 1,
        ("s.X", "not_null"): 1, ("s.X", "convertible"): 1, ("s.y.z", "not_null"): 1,
    }


def test_maps_kept_as_maps_empty_tables_and_nothing_nested(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    as_map = [ExpectedColumn("m", "map<bigint, numeric(30,2)>")]
    assert found(frame, as_map) == {("m{key}", "convertible"): 1, ("m{value}", "convertible"): 0, ("m{value}", "scale"): 1}
    assert set(found(frame.limit(0), EXPECTED).values()) == {0}
    assert found(frame, [ExpectedColumn("plain", "bigint"), ExpectedColumn("a", "ARRAY")]) == {}
