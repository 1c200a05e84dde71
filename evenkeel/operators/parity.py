"""Row-count, aggregate, fingerprint and query parity of two frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import digest
from evenkeel.functions.canon import FLOAT_DECIMALS, column, number_text, type_of
from evenkeel.functions.tolerance import Tolerance, allowed, close_numbers, terms, within, within_seconds
from evenkeel.operators.checks import side_by_side, to_checks, union_all


@dataclass(frozen=True)
class TablePair:
    """Two frames whose row counts should agree, each with an optional filter."""

    name: str
    source: DataFrame
    target: DataFrame
    tolerance: Tolerance = 0
    source_filter: Column | str | None = None
    target_filter: Column | str | None = None


def rowcount_parity(pairs: Sequence[TablePair]) -> DataFrame:
    """One check per pair, also for pairs of one name; all are counted in one job without a join."""
    counted = []
    for i, pair in enumerate(pairs):
        for is_source, df, condition in (
            (True, pair.source, pair.source_filter),
            (False, pair.target, pair.target_filter),
        ):
            rows = df if condition is None else df.where(condition)
            counted.append(
                rows.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(i).alias("pair"), F.lit(pair.name).alias("name"), F.lit(is_source).alias("is_source"), "n"
                )
            )
    wide = union_all(counted).groupBy("pair", "name").agg(
        F.sum(F.when(F.col("is_source"), F.col("n"))).alias("s"),
        F.sum(F.when(~F.col("is_source"), F.col("n"))).alias("t"),
    )
    limit = F.lit(None).cast("double")
    for i, pair in enumerate(pairs):
        limit = F.when(F.col("pair") == i, allowed(pair.tolerance, F.col("s"))).otherwise(limit)
    wide = wide.withColumn("delta", F.abs(F.col("s") - F.col("t"))).withColumn("allowed", limit)
    return to_checks(
        wide,
        "rowcount_parity",
        F.col("name"),
        F.col("delta") <= F.col("allowed"),
        F.format_string("source=%s target=%s delta=%s", "s", "t", "delta"),
        F.col("s"),
        F.col("t"),
        {"delta": F.col("delta"), "allowed": F.col("allowed")},
    )


@dataclass(frozen=True)
class Aggregate:
    """A column aggregate to compare; ``fn`` is sum, count, count_distinct, min or max."""

    column: str
    fn: str
    tolerance: Tolerance = 0

    @property
    def label(self) -> str:
        return f"{self.column}:{self.fn}"

    def expression(self) -> Column:
        functions = {"sum": F.sum, "count": F.count, "count_distinct": F.count_distinct, "min": F.min, "max": F.max}
        return functions[self.fn](column(self.column))


def _long_aggregates(df: DataFrame, aggregates: Sequence[Aggregate]) -> DataFrame:
    """(position, text, is_number, instant) per aggregate, all from one pass over the data."""
    row = df.agg(*[a.expression().alias(f"a{i}") for i, a in enumerate(aggregates)])
    entries = []
    for i, field in enumerate(row.schema.fields):
        value = F.col(field.name)
        instant = isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                value.cast("string").alias("text"),
                F.lit(isinstance(field.dataType, (T.NumericType, T.StringType))).alias("is_number"),
                (value if instant else F.lit(None)).cast("timestamp").alias("instant"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def aggregate_parity(
    name: str, source: DataFrame, target: DataFrame, aggregates: Sequence[Aggregate]
) -> DataFrame:
    """One check per aggregate; each side is read once for all of them.

    Names and tolerances are arrays looked up by position, so that the verdict is one expression over the rows
    and planning does not grow with the number of aggregates.
    """
    tagged = _long_aggregates(source, aggregates).withColumn("is_source", F.lit(True)).unionByName(
        _long_aggregates(target, aggregates).withColumn("is_source", F.lit(False))
    ).withColumn("number", F.when(F.col("is_number"), number_text(F.col("text"))))
    picked = []
    for c in ("text", "number", "instant"):
        picked.append(F.max(F.when(F.col("is_source"), F.col(c))).alias(f"s_{c}"))
        picked.append(F.max(F.when(~F.col("is_source"), F.col(c))).alias(f"t_{c}"))
    absolute, share = zip(*(terms(a.tolerance) for a in aggregates), strict=True)
    of = lambda values: F.get(F.lit(list(values)), F.col("position"))
    base = F.coalesce(F.abs(F.col("s_number").try_cast("double")), F.lit(0.0))
    wide = tagged.groupBy("position").agg(*picked).select(
        "*",
        of(f"{name}.{a.label}" for a in aggregates).alias("label"),
        of(str(a.tolerance).strip().endswith("%") for a in aggregates).alias("by_share"),
        of(absolute).alias("absolute"),
        (of(absolute) + of(share) * base).alias("allowed"),
    )
    same = F.col("s_text").eqNullSafe(F.col("t_text"))
    instants = F.col("s_instant").isNotNull()
    numbers = F.col("s_number").isNotNull() & F.col("t_number").isNotNull()
    passed = (
        F.when(instants & ~F.col("by_share"), within_seconds(F.col("s_instant"), F.col("t_instant"), F.col("absolute")))
        .when(numbers & ~instants, close_numbers(F.col("s_number"), F.col("t_number"), F.col("allowed")))
        .otherwise(same)
    )
    return to_checks(
        wide,
        "aggregate_parity",
        F.col("label"),
        passed,
        F.concat_ws(" ", F.lit("source:"), "s_text", F.lit("target:"), "t_text"),
        F.col("s_text"),
        F.col("t_text"),
    )


def fingerprint_parity(
    name: str,
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
) -> DataFrame:
    """Both frames hold the same multiset of rows over ``columns``, in any order."""
    sides = [digest.exact_fingerprint(df, columns, decimals, numeric_strings) for df in (source, target)]
    wide = side_by_side(*sides, ["row_count", "digest"])
    return _digest_check(wide, "fingerprint_parity", name, "digest")


def fast_fingerprint_parity(name: str, source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``fingerprint_parity`` with 60-bit hashes: cheaper, and blind to equal sums."""
    sides = [digest.fast_fingerprint(df, columns) for df in (source, target)]
    wide = side_by_side(*sides, ["row_count", "hash_sum"])
    return _digest_check(wide, "fingerprint_parity", name, "hash_sum")


def _digest_check(wide: DataFrame, pattern: str, name: str, value: str) -> DataFrame:
    same = F.col("s_row_count") == F.col("t_row_count")
    return to_checks(
        wide,
        pattern,
        name,
        same & F.col(f"s_{value}").eqNullSafe(F.col(f"t_{value}")),
        F.format_string("source rows=%s target rows=%s", "s_row_count", "t_row_count"),
        F.col(f"s_{value}"),
        F.col(f"t_{value}"),
        {"source_rows": F.col("s_row_count"), "target_rows": F.col("t_row_count")},
    )


def rowset_parity(
    name: str,
    source: DataFrame,
    target: DataFrame,
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
) -> DataFrame:
    """Two query results agree as multisets; a column one of them lacks counts as NULL."""
    columns = sorted({c.lower() for c in source.columns} | {c.lower() for c in target.columns})
    sides = [digest.exact_fingerprint(df, columns, decimals, numeric_strings) for df in (source, target)]
    return _digest_check(side_by_side(*sides, ["row_count", "digest"]), "query_parity", name, "digest")


def scalar_parity(name: str, source: DataFrame, target: DataFrame, tolerance: Tolerance = 0) -> DataFrame:
    """The first cell of two results agrees within the tolerance; no row counts as NULL."""
    cells = []
    for df in (source, target):
        first = df.columns[0]
        numeric = isinstance(type_of(df, first), (T.NumericType, T.StringType))
        cell = column(first)
        cells.append(
            df.limit(1).select(
                cell.cast("string").alias("text"),
                F.when(F.lit(numeric), number_text(cell.cast("string"))).alias("number"),
            )
        )
    wide = side_by_side(*cells, ["text", "number"])
    numbers = F.col("s_number").isNotNull() & F.col("t_number").isNotNull()
    passed = F.when(numbers, within(F.col("s_number"), F.col("t_number"), tolerance)).otherwise(
        F.col("s_text").eqNullSafe(F.col("t_text"))
    )
    return to_checks(wide, "query_parity", name, passed, "scalar", F.col("s_text"), F.col("t_text"))
