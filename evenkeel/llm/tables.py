"""Inputs of the operators and what they share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.session import fresh_path


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that nothing before it runs again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lowered(text: Column) -> Column:
    """A-Z to a-z and no other letter; plain ASCII texts take the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def id_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo five; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long): the smallest node it reaches.

    Each round maps a node to its best neighbour and contracts the links. Best is the smallest id in even
    rounds, which folds a star at once, and the smallest hash in odd ones, which shortens a path by a constant
    share. Rounds are written to the shared folder; minima are pre-aggregated, so a hub costs one row per
    task. Links with a NULL end are ignored; no link gives no row.
    """
    alive = written(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    reached, turn = None, 0
    while reached is None or not alive.isEmpty():
        rank = F.lit(0).cast("long") if turn % 2 == 0 else F.xxhash64("node", F.lit(turn))
        both = alive.select(F.col("a").alias("x"), F.col("b").alias("node")).union(alive.select("b", "a"))
        best = both.groupBy("x").agg(F.min(F.struct(rank.alias("rank"), "node")).alias("m"))
        own = F.struct((F.lit(0).cast("long") if turn % 2 == 0 else F.xxhash64("x", F.lit(turn))).alias("rank"), F.col("x").alias("node"))
        step = written(best.select("x", F.least(F.col("m"), own)["node"].alias("to")), "step")
        if reached is None:
            reached = step.withColumnsRenamed({"x": "node", "to": "at"})
        else:
            moved = reached.join(step, reached["at"] == step["x"], "left").select("node", F.coalesce("to", "at").alias("at"))
            reached = written(moved, "reached")
        left, right = step.select(F.col("x").alias("a"), F.col("to").alias("p")), step.select(F.col("x").alias("b"), F.col("to").alias("q"))
        alive = written(alive.join(left, "a").join(right, "b").where("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")), "links")
        turn += 1
    least = reached.groupBy("at").agg(F.min("node").alias("component"))
    return reached.join(least, "at").select("node", "component")
