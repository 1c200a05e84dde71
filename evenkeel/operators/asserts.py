"""Tests of transforms: expected rows, properties, and two transforms against each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import scalars
from evenkeel.functions.canon import canonical, column, type_of
from evenkeel.operators.checks import to_checks, union_all
from evenkeel.operators.localize import lower_case_columns, multiset_difference

Transform = str | Callable[..., DataFrame]


def run_transform(transform: Transform, given: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL text with ``{name}`` placeholders, or a function, on the given frames."""
    if callable(transform):
        return transform(**given)
    spark = next(iter(given.values())).sparkSession
    return spark.sql(transform, **given)


def coerce_expected(df: DataFrame) -> DataFrame:
    """ISO dates and timestamps spelled as strings print as the values they stand for."""
    columns = []
    for f in df.schema.fields:
        col = column(f.name)
        if isinstance(f.dataType, T.StringType):
            instant = scalars.iso_timestamp(col)
            col = F.coalesce(F.date_trunc("second", instant).cast("string"), col)
        columns.append(col.alias(f.name))
    return df.select(*columns)


def rows_equal(
    name: str, actual: DataFrame, expected: DataFrame, pattern: str = "transform_unit"
) -> DataFrame:
    """The output equals the expected rows as a multiset, over the expected columns only."""
    columns = [c for c in expected.columns]
    surplus = multiset_difference(coerce_expected(expected), coerce_expected(actual), columns, numeric_strings=True)
    counts = surplus.agg(
        F.coalesce(F.sum(F.when(F.col("side") == "only_source", F.col("copies"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("side") == "only_target", F.col("copies"))), F.lit(0)).alias("extra"),
    )
    return to_checks(
        counts,
        pattern,
        name,
        (F.col("missing") == 0) & (F.col("extra") == 0),
        F.format_string("%s missing, %s unexpected", "missing", "extra"),
        metrics={"missing": F.col("missing"), "extra": F.col("extra")},
    )


def transform_unit(
    name: str, transform: Transform, given: Mapping[str, DataFrame], expected: DataFrame
) -> DataFrame:
    return rows_equal(name, run_transform(transform, given), expected)


def transform_diff(
    name: str, legacy: Transform, migrated: Transform, given: Mapping[str, DataFrame]
) -> DataFrame:
    """Two transforms of the same input give the same columns and the same multiset of rows."""
    old = lower_case_columns(run_transform(legacy, given))
    new = lower_case_columns(run_transform(migrated, given))
    if set(old.columns) != set(new.columns):
        odd = ", ".join(sorted(set(old.columns) ^ set(new.columns)))
        one = old.sparkSession.range(1)
        return to_checks(one, "transform_diff", name, F.lit(False), f"columns differ: {odd}")
    return rows_equal(name, new, old, "transform_diff")


def property_asserts(
    name: str,
    df: DataFrame,
    rowcount: int | None = None,
    unique: Sequence[Sequence[str]] = (),
    no_nulls: Sequence[str] = (),
) -> DataFrame:
    """Row count, unique key sets and NULL-free columns, all from one pass."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    aggregates += [F.count_if(column(c).isNull()).alias(f"z{i}") for i, c in enumerate(no_nulls)]
    for i, keys in enumerate(unique):
        # one text per key tuple: NULLs count as values, as in the tuple itself
        text = F.concat_ws("\x1f", *[canonical(column(k), type_of(df, k)) for k in keys])
        aggregates.append(F.count_distinct(text).alias(f"u{i}"))
    row = df.agg(*aggregates)

    def entry(target: str, expected: Column, actual: Column) -> Column:
        return F.struct(
            F.lit(target).alias("target"),
            expected.cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
        )

    entries = []
    if rowcount is not None:
        entries.append(entry(f"{name}.rowcount", F.lit(rowcount), F.col("n")))
    entries += [entry(f"{name}.unique({', '.join(k)})", F.col("n"), F.col(f"u{i}")) for i, k in enumerate(unique)]
    entries += [entry(f"{name}.{c} no_nulls", F.lit(0), F.col(f"z{i}")) for i, c in enumerate(no_nulls)]
    checked = row.select(F.inline(F.array(*entries)))
    return to_checks(
        checked,
        "transform_unit",
        F.col("target"),
        F.col("expected") == F.col("actual"),
        F.format_string("expected %s, found %s", "expected", "actual"),
        F.col("expected"),
        F.col("actual"),
    )


def suite(checks: Sequence[DataFrame]) -> DataFrame:
    """Several checks frames as one, evaluated in one job."""
    return union_all(list(checks))
