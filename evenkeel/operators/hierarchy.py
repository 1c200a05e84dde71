"""Parent/child trees: walked level by level down to a given depth, or resolved whole by pointer doubling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.operators.checks import union_all
from evenkeel.session import durable


def descend(
    nodes: DataFrame,
    node_id: str,
    parent_id: str,
    label: str,
    max_depth: int,
    keep: Sequence[str] = (),
    separator: str = " > ",
) -> DataFrame:
    """(node_id, keep..., root_id, depth, path) for each node within ``max_depth`` of a root.

    Deeper nodes do not appear; ``ancestry`` finds the root and the depth of every node. A root has no parent. Cycles and nodes under a missing parent never appear. There is one
    join per level; the levels below reuse its exchange, so no level is shuffled twice.
    """
    columns = list(dict.fromkeys([node_id, *keep]))
    roots = nodes.where(column(parent_id).isNull())
    level = roots.select(
        *columns,
        column(node_id).alias("root_id"),
        F.lit(0).alias("depth"),
        column(label).alias("path"),
    )
    levels = [level]
    children = nodes.where(column(parent_id).isNotNull()).select(
        *columns, column(parent_id).alias("_parent"), column(label).alias("_label")
    )
    for _ in range(max_depth):
        above = level.select(
            column(node_id).alias("_above"),
            "root_id",
            (F.col("depth") + 1).alias("depth"),
            F.col("path").alias("_path"),
        )
        level = children.join(above, F.col("_parent") == F.col("_above")).select(
            *columns, "root_id", "depth", F.concat("_path", F.lit(separator), "_label").alias("path")
        )
        levels.append(level)
    return union_all(levels)


def ancestry(nodes: DataFrame, node_id: str, parent_id: str) -> DataFrame:
    """(node_id, root_id, depth, status) of every node, however deep.

    Pointer doubling: a node that points to an ancestor takes over where that one points, so each round doubles the
    distance, and about log2(depth) rounds reach every root. Each round is written; nodes that arrived take no further part.
    ``status`` is rooted; orphan for nodes under a parent that is not in the frame, whose id is then root_id; or cycle
    for nodes on a cycle or below one, without root and depth. Nodes with a NULL id are left out, repeated rows
    count once, and a node with two parents stops the job.
    """
    links = nodes.where(column(node_id).isNotNull()).select(column(node_id).alias("node"), column(parent_id).alias("top"))
    parents = links.groupBy("node").agg(F.min("top").alias("top"), F.max("top").alias("_other"), F.count_if(F.col("top").isNull()).alias("_none"))
    clash = (F.col("top") != F.col("_other")) | ((F.col("_none") > 0) & F.col("top").isNotNull())
    refused = F.raise_error(F.concat(F.lit("node with two parents: "), F.col("node").cast("string"))).cast("boolean")
    once = parents.where(F.when(clash, refused).otherwise(F.lit(True)))
    root = F.col("top").isNull()
    state = durable(
        once.select(
            "node", F.coalesce("top", "node").alias("top"), F.when(root, 0).otherwise(1).cast("bigint").alias("hops"),
            F.when(root, "rooted").alias("status"),
        )
    )
    total, reach = state.count(), 1
    arrived = [state.where(F.col("status").isNotNull())]
    moving = state.where(F.col("status").isNull())
    while reach <= total and not moving.isEmpty():
        known = union_all([*arrived, moving]).select(
            F.col("node").alias("_at"), F.col("top").alias("_top"), F.col("hops").alias("_hops"), F.col("status").alias("_status")
        )
        met = moving.join(known, F.col("top") == F.col("_at"), "left")
        found = F.col("_at").isNotNull()
        moved = met.select(
            "node", F.when(found, F.col("_top")).otherwise(F.col("top")).alias("top"),
            (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), F.when(found, F.col("_status")).otherwise(F.lit("orphan")).alias("status"),
        )
        moved = durable(moved)
        arrived.append(moved.where(F.col("status").isNotNull()))
        moving = moved.where(F.col("status").isNull())
        reach *= 2
    none = F.lit(None)
    cyclic = moving.select("node", none.cast(state.schema["top"].dataType).alias("top"), none.cast("bigint").alias("hops"), F.lit("cycle").alias("status"))
    return union_all([*arrived, cyclic]).select(F.col("node").alias(node_id), F.col("top").alias("root_id"), F.col("hops").alias("depth"), "status")
