"""Incremental intake by a check column, once as a batch and once as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evenkeel.functions.canon import column
from evenkeel.sources.versioned import VersionedTable

WATERMARKS = "source_table string, last_value string, last_run_ts timestamp, run_id string"


def new_rows(df: DataFrame, check_column: str, last_value: str | None) -> DataFrame:
    """Rows past the last value seen; all of them on the first run."""
    if last_value is None:
        return df
    return df.where(column(check_column) > F.lit(last_value).cast(df.schema[check_column].dataType))


def next_watermark(
    df: DataFrame, source_table: str, check_column: str, run_id: str, run_ts: str, last_value: str | None
) -> DataFrame:
    """The control row after taking ``df``: its highest check value, or the old one if it is empty."""
    highest = F.max(column(check_column)).cast("string")
    return df.agg(F.coalesce(highest, F.lit(last_value).cast("string")).alias("last_value")).select(
        F.lit(source_table).alias("source_table"),
        "last_value",
        F.lit(run_ts).cast("timestamp").alias("last_run_ts"),
        F.lit(run_id).alias("run_id"),
    )


def file_stream(spark: SparkSession, path: str, schema, format: str = "parquet") -> DataFrame:
    """A folder of files as a stream; each file is taken once."""
    return spark.readStream.format(format).schema(schema).load(path)


def append_stream(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str,
    lateness: str,
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to Parquet without duplicate keys inside the lateness bound.

    State is only kept for the bound. ``checkpoint`` must lie in storage all executors share;
    a restart goes on from it.
    """
    unique = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))
    writer = unique.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ledgered_stream(
    stream: DataFrame, table: VersionedTable, name: str, checkpoint: str, check_column: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append a stream to a versioned table, each batch exactly once, with one audit entry per batch.

    The table's commit holds the last batch of ``name`` together with the batch's files. A batch that is played again
    after a failure, before the checkpoint knew of it, finds its number there and adds nothing.
    """

    def take(rows: DataFrame, batch: int) -> None:
        table.append(rows, name, batch, f"{name}-{batch}", check_column)

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def audit_rows(table: VersionedTable) -> DataFrame:
    """(run_id, action, n_rows, last_value, status) of every run, in the order of versions; n_rows counts rows added."""
    before = F.coalesce(F.lag("n_rows").over(Window.orderBy("version")), F.lit(0))
    added = F.col("n_rows") - F.when(F.col("action") == "overwrite", 0).otherwise(before)
    # one row per version
    return table.history().select("version", "run_id", "action", added.alias("n_rows"), "last_value", F.lit("SUCCESS").alias("status")).orderBy("version")
