"""Tables and files written: full rewrites, partitioned layouts, exports and loads with a check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import digest, exact
from evenkeel.functions.canon import column
from evenkeel.operators.checks import side_by_side, to_checks, union_all
from evenkeel.session import setting
from evenkeel.sources.readers import Schema, read_files


def replace_table(df: DataFrame, table: str, format: str = "parquet") -> None:
    """CREATE OR REPLACE TABLE AS SELECT."""
    df.write.mode("overwrite").format(format).saveAsTable(table)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    files_per_partition: int = 1,
    format: str = "parquet",
) -> None:
    """Partition folders with rows clustered inside their files.

    ``files_per_partition`` spreads one large partition value over that many tasks and files.
    """
    by = [column(c) for c in partition_by]
    if files_per_partition > 1:
        spread = [column(c) for c in cluster_by] or [column(c) for c in df.columns if c not in partition_by]
        by.append(F.pmod(F.xxhash64(*spread), F.lit(files_per_partition)))
    laid_out = df.repartition(*by)
    if cluster_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *cluster_by)
    laid_out.write.mode("overwrite").format(format).partitionBy(*partition_by).save(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, key: str, sort_by: str | None = None, format: str = "orc"
) -> None:
    """A bucketed table: later joins on the key need no shuffle."""
    writer = df.write.mode("overwrite").format(format).bucketBy(buckets, key)
    (writer.sortBy(sort_by) if sort_by else writer).saveAsTable(table)


def insert_partitions(staged: DataFrame, table: str) -> None:
    """Replace only the partitions the staged rows belong to."""
    spark = staged.sparkSession
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        staged.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def export_json(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """Newline-delimited JSON files, replacing what the folder held."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def retain_partitions(df: DataFrame, day: str, days: int, as_of: str) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``; the filter prunes partitions."""
    return df.where(column(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def swap_in(df: DataFrame, path: str, staging_path: str, format: str = "parquet") -> None:
    """Write a result that reads ``path`` itself: stage it first, then overwrite from the stage."""
    df.write.mode("overwrite").format(format).save(staging_path)
    df.sparkSession.read.format(format).load(staging_path).write.mode("overwrite").format(format).save(path)


@dataclass(frozen=True)
class Load:
    """One bulk load: where from, in which format, and what should land."""

    name: str
    path: str
    format: str
    destination: str
    expected_count: int | None = None
    partition_column: str | None = None
    schema: Schema = None
    delimiter: str = ","
    skip_leading_rows: int = 0
    partition_prefix: str | None = None
    partition_types: str = "auto"


def _failed(spark: SparkSession, target: str, message: str) -> DataFrame:
    return to_checks(spark.range(1), "bulk_load", target, F.lit(False), message)


def bulk_load(spark: SparkSession, load: Load) -> DataFrame:
    """Load, replace the destination, and check what landed; a load that breaks is a FAIL.

    A CSV or JSON record that does not fit its types breaks the load.

    The count is read back from the destination, so a retried write task cannot inflate it.
    """
    try:
        rows = read_files(
            spark,
            load.path,
            load.format,
            load.schema,
            delimiter=load.delimiter,
            skip_leading_rows=load.skip_leading_rows,
            partition_prefix=load.partition_prefix,
            partition_types=load.partition_types,
            strict=True,
        )
        rows.write.mode("overwrite").parquet(load.destination)
    except (PySparkException, Py4JJavaError, ValueError) as error:
        return _failed(spark, load.name, f"load failed: {str(error).splitlines()[0]}")
    landed = spark.read.schema(rows.schema).parquet(load.destination)
    checks = []
    counted = landed.agg(F.count(F.lit(1)).alias("n"))
    expected = F.lit(load.expected_count)
    checks.append(
        to_checks(
            counted,
            "bulk_load",
            load.name,
            F.lit(True) if load.expected_count is None else F.col("n") == expected,
            F.concat(F.col("n").cast("string"), F.lit(" rows landed")),
            None if load.expected_count is None else expected,
            F.col("n"),
        )
    )
    if load.partition_column is not None:
        present = load.partition_column.lower() in [c.lower() for c in landed.columns]
        checks.append(
            to_checks(
                spark.range(1),
                "bulk_load",
                f"{load.name} (partition column {load.partition_column})",
                F.lit(present),
                "present" if present else "missing from the loaded table",
            )
        )
    return union_all(checks)


def egress_parity(
    name: str,
    source: DataFrame,
    exported: DataFrame,
    columns: Sequence[str],
    control_total: str | None = None,
) -> DataFrame:
    """Exported files against the rows they should hold: same multiset, count and control total."""
    sides = [digest.exact_fingerprint(df, columns, numeric_strings=True) for df in (source, exported)]
    wide = side_by_side(*sides, ["row_count", "digest"])
    checks = [
        to_checks(
            wide,
            "egress_parity",
            f"{name} (identity)",
            F.col("s_digest") == F.col("t_digest"),
            F.format_string("rows source=%s exported=%s", "s_row_count", "t_row_count"),
            F.col("s_digest"),
            F.col("t_digest"),
        ),
        to_checks(
            wide,
            "egress_parity",
            f"{name} (row count)",
            F.col("s_row_count") == F.col("t_row_count"),
            "",
            F.col("s_row_count"),
            F.col("t_row_count"),
        ),
    ]
    if control_total is not None:
        totals = side_by_side(*[exact.digit_sums(df, column(control_total)) for df in (source, exported)], ["sums", "beyond"])
        totals = totals.select("*", *[exact.sums_text(f"{side}_sums").alias(f"{side}_total") for side in "st"])
        checks.append(
            to_checks(
                totals,
                "egress_parity",
                f"{name} (control total {control_total})",
                (F.col("s_total") == F.col("t_total")) & (F.col("s_beyond") == 0) & (F.col("t_beyond") == 0),
                F.concat(F.lit("variance "), exact.difference_text("s_sums", "t_sums")),
                F.col("s_total"),
                F.col("t_total"),
            )
        )
    return union_all(checks)


def exact_totals(df: DataFrame, amount: Column | str) -> DataFrame:
    """One row (row_count, total, beyond): the total with all its digits, as text.

    A NULL or unparseable amount counts as 0; ``beyond`` counts numbers of more digits than ``exact`` holds.
    """
    value = column(amount) if isinstance(amount, str) else amount
    return exact.digit_sums(df, value).select("row_count", exact.sums_text("sums").alias("total"), "beyond")


def control_totals(df: DataFrame, amount: Column | str) -> DataFrame:
    """One row (row_count, total): ``exact_totals`` as a number, rounded once to nine places."""
    return exact_totals(df, amount).select("row_count", F.col("total").cast("decimal(38,9)").alias("total"))
