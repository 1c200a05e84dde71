"""Neighbours and running sums within a key, also for keys with very many rows.

A plain window sends every row of a key to one task. Here a key with more than
``ROWS_PER_CHUNK`` rows is cut into chunks of about equal row counts along its whole order,
NULLs and far outliers included; the window runs per (key, chunk), and what crosses a chunk
border comes from a small table with one row per chunk. Where no key is that large, which one
aggregation over the key column finds out, the plan is the plain window.

The cut points are quantiles of a random sample of the key's rows, ``SAMPLES_PER_CHUNK`` rows
for each chunk. They are written before use, so a lost task that runs again cuts the same way.
Rows that are equal in every order column stay in one chunk; a tie-break in the order parts
them. An empty list of keys takes the whole frame as one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.session import durable

ROWS_PER_CHUNK = 2_000_000
#: Sampled rows per chunk; with this many a chunk of twice the mean is eight deviations away.
SAMPLES_PER_CHUNK = 64
#: A key is cut into no more chunks than this; beyond it the chunks grow instead.
MOST_CHUNKS = 65_536
BROADCAST_BYTES = 16 << 20
#: A row's chunk is found in two steps: among every 256th cut, then among the 256 from there.
STRIDE = 256


@dataclass(frozen=True)
class Cuts:
    """How the large keys of a frame are cut; ``table`` is None when there are none.

    Cuts stay valid for any later frame whose rows have the same keys and order values.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    table: DataFrame | None


def _same(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    return [column(a).eqNullSafe(column(b)) for a, b in zip(left, right)]


def _renamed(keys: Sequence[str]) -> list[str]:
    return [f"_key{i}" for i in range(len(keys))]


def _written(df: DataFrame) -> DataFrame:
    """A written table that later joins broadcast only when its measured bytes are few."""
    table = durable(df)
    size = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def _place(df: DataFrame, order: Sequence[str]) -> Column:
    """The order values of a row as one comparable value; NULLs come first."""
    return F.struct(*[column(o).alias(f"o{i}") for i, o in enumerate(order)])


def _quantiles(sample: Column, parts: Column) -> Column:
    """The sorted sample's values that part it into ``parts`` runs of equal length."""
    rank = lambda i: F.floor(i * F.size(sample) / parts).cast("int")
    return F.transform(F.sequence(F.lit(1).cast("bigint"), parts - 1), lambda i: sample[rank(i)])


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK
) -> Cuts:
    """Run the sizing job, and for keys with more than ``rows_per_chunk`` rows the sampling job.

    There are at most rows / rows_per_chunk large keys. Their cuts are kept as a written table,
    which is only broadcast when its measured bytes are few.
    """
    order = (order,) if isinstance(order, str) else tuple(order)
    names = _renamed(keys)
    rows = df.select(*[column(k).alias(r) for k, r in zip(keys, names)], _place(df, order).alias("_at"))
    parts = F.least(F.ceil(F.col("_n") / F.lit(rows_per_chunk)), F.lit(MOST_CHUNKS)).cast("bigint")
    large = (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_chunk)
        .select(*[column(r).alias(f"_large{r}") for r in names], parts.alias("_parts"), "_n")
        .withColumn("_rate", F.col("_parts") * SAMPLES_PER_CHUNK / F.col("_n"))
    )
    if large.isEmpty():
        return Cuts(tuple(keys), order, None)
    large = durable(large)
    if names:
        sized = rows.join(_written(large), _same(names, [f"_large{r}" for r in names]))
    else:
        whole = large.first()
        sized = rows.withColumns({"_parts": F.lit(whole["_parts"]), "_rate": F.lit(whole["_rate"])})
    sampled = sized.where(F.rand(17) < F.col("_rate")).groupBy(*names).agg(
        F.sort_array(F.collect_list("_at")).alias("_sample"), F.first("_parts").alias("_parts")
    )
    cuts = sampled.where(F.size("_sample") > 0).select(*names, _quantiles(F.col("_sample"), F.col("_parts")).alias("_cuts"))
    steps = F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / STRIDE).cast("int"))
    table = cuts.select(
        *names,
        F.transform(steps, lambda j: F.col("_cuts")[j * STRIDE]).alias("_coarse"),
        F.transform(steps, lambda j: F.slice("_cuts", j * STRIDE + 1, F.lit(STRIDE))).alias("_fine"),
    )
    return Cuts(tuple(keys), order, _written(table))


def _chunked(df: DataFrame, cuts: Cuts) -> DataFrame:
    """``df`` with ``_chunk``: NULL for ordinary keys, ascending along the order for large ones."""
    rows = df.withColumn("_at", _place(df, cuts.order))
    if cuts.keys:
        joined = rows.join(cuts.table, _same(cuts.keys, _renamed(cuts.keys)), "left")
    else:
        joined = rows.withColumns({c: cuts.table.select(c).scalar() for c in ("_coarse", "_fine")})
    at = F.col("_at")
    stride = F.size(F.filter("_coarse", lambda c: c <= at))
    inside = F.size(F.filter(F.col("_fine")[stride - 1], lambda c: c <= at))
    chunk = F.when(stride == 0, F.lit(0)).otherwise((stride - 1) * STRIDE + inside)
    placed = F.when(F.col("_coarse").isNotNull(), chunk.cast("bigint"))
    return joined.select(*[column(c) for c in df.columns], placed.alias("_chunk"))


def _across(edges: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """One value per chunk under names that do not clash with the rows'."""
    return edges.select(
        *[column(k).alias(r) for k, r in zip(keys, _renamed(keys))],
        F.col("_chunk").alias("_edge_chunk"),
        value.alias("_across"),
    )


def _checked(cuts: Cuts, keys: Sequence[str], order: Sequence[str]) -> Cuts:
    if cuts.keys != tuple(keys) or cuts.order != tuple(order[: len(cuts.order)]):
        raise ValueError(f"cuts of {cuts.keys} along {cuts.order} do not fit {tuple(keys)} along {tuple(order)}")
    return cuts


def _edges(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], first: bool) -> DataFrame:
    """(keys, _chunk, _near): the values of each chunk's first or last row.

    The extreme place is found over the order columns alone, and only the rows at it carry their values.
    """
    placed = rows.where(F.col("_chunk").isNotNull()).withColumn("_place", _place(rows, order))
    extreme = (F.min if first else F.max)("_place").alias("_extreme")
    names = _renamed(keys)
    found = placed.groupBy(*keys, "_chunk").agg(extreme).select(
        *[column(k).alias(r) for k, r in zip(keys, names)], F.col("_chunk").alias("_edge_chunk"), "_extreme"
    )
    same = _same([*keys, "_chunk", "_place"], [*names, "_edge_chunk", "_extreme"])
    picked = F.struct(*[column(c).alias(name) for name, c in values.items()])
    return placed.join(_written(found), same).groupBy(*keys, "_chunk").agg(F.first(picked).alias("_near"))


def _with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    cuts: Cuts | None,
    forward: bool,
) -> DataFrame:
    cuts = _checked(cuts or find_cuts(df, keys, order), keys, order)
    step = F.lead if forward else F.lag
    ascending = [column(o).asc_nulls_first() for o in order]
    if cuts.table is None:
        w = Window.partitionBy(*keys).orderBy(*ascending)
        return df.select("*", *[step(column(c)).over(w).alias(name) for name, c in values.items()])
    rows = _chunked(df, cuts)
    within = Window.partitionBy(*keys, "_chunk").orderBy(*ascending)
    at_edge = step(F.lit(True)).over(within).isNull()
    local = rows.select(
        "*", at_edge.alias("_edge"), *[step(column(c)).over(within).alias(name) for name, c in values.items()]
    )
    edges = _edges(rows, keys, order, values, forward)
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    near = _written(_across(edges, keys, step("_near").over(by_chunk)))
    joined = local.join(near, _same([*keys, "_chunk"], [*_renamed(keys), "_edge_chunk"]), "left")
    filled = [
        F.when(F.col("_edge"), F.col("_across").getField(name)).otherwise(column(name)).alias(name) for name in values
    ]
    return joined.select(*[column(c) for c in df.columns], *filled)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], cuts: Cuts | None = None
) -> DataFrame:
    """Add columns holding the previous row's values within the key: {new name: column}."""
    return _with_neighbour(df, keys, order, values, cuts, forward=False)


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], cuts: Cuts | None = None
) -> DataFrame:
    """Add columns holding the next row's values within the key: {new name: column}."""
    return _with_neighbour(df, keys, order, values, cuts, forward=True)


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, name: str, cuts: Cuts | None = None
) -> DataFrame:
    """Add the sum of ``amount`` over the rows of the key up to and including this one."""
    cuts = _checked(cuts or find_cuts(df, keys, order), keys, order)
    ascending = [column(o).asc_nulls_first() for o in order]
    upto = (Window.unboundedPreceding, Window.currentRow)
    if cuts.table is None:
        w = Window.partitionBy(*keys).orderBy(*ascending).rowsBetween(*upto)
        return df.select("*", F.sum(amount).over(w).alias(name))
    rows = _chunked(df, cuts)
    local = rows.withColumn("_sum", F.sum(amount).over(Window.partitionBy(*keys, "_chunk").orderBy(*ascending).rowsBetween(*upto)))
    totals = rows.where(F.col("_chunk").isNotNull()).groupBy(*keys, "_chunk").agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = _written(_across(totals, keys, F.sum("_total").over(before)))
    joined = local.join(carried, _same([*keys, "_chunk"], [*_renamed(keys), "_edge_chunk"]), "left")
    total = F.col("_sum") + F.coalesce(F.col("_across"), F.lit(0))
    return joined.select(*[column(c) for c in df.columns], total.alias(name))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only one row per key and map task before the shuffle (window group limit),
    so a key with very many rows does not travel.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def nearest_rank_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    percents: Sequence[int],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Nearest-rank percentiles p<percent>, with runs, min and max, per group.

    Equal values are counted first; the rank is then a running sum over distinct values.
    """
    counts = df.where(column(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_copies"))
    cuts = find_cuts(counts, groups, [value], rows_per_chunk)
    ranked = with_running_sum(counts, groups, [value], "_copies", "_upto", cuts)
    totals = df.where(column(value).isNotNull()).groupBy(*groups).agg(F.count(F.lit(1)).alias("_all"))
    totals = totals.select(*[column(g).alias(r) for g, r in zip(groups, _renamed(groups))], "_all")
    joined = ranked.join(totals, _same(groups, _renamed(groups)))
    picks = []
    for p in percents:
        # rank >= ceil(p / 100 * all), in whole numbers
        reached = F.col("_upto") * 100 >= F.col("_all") * p
        picks.append(F.min(F.when(reached, column(value))).alias(f"p{p}"))
    return joined.groupBy(*groups).agg(
        F.sum("_copies").alias("runs"), *picks, F.min(value).alias("min"), F.max(value).alias("max")
    )
