"""Which keys or rows differ between two frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import digest
from evenkeel.functions.canon import FLOAT_DECIMALS, canonical, column, row_text, type_of


def _key_bucket(df: DataFrame, key: Sequence[str], buckets: int) -> Column:
    return digest.key_bucket(F.concat_ws("\x1f", *[canonical(column(k), type_of(df, k)) for k in key]), buckets)


ROW_WORDS = [f"_w{i}" for i in digest.WORDS]


def differing_rows_of(df: DataFrame, key: Sequence[str], columns: Sequence[str], exact: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """(key..., keep..., _w0 to _w3): the whole digest of each row as four longs, 256 bits where ``exact``, else 128."""
    text = digest.exact_row_hash(df, columns) if exact else digest.fast_row_hash(df, columns)
    names = list(dict.fromkeys([*key, *keep]))
    hashed = df.select(*[column(c).alias(c) for c in names], text.alias("_hash"))
    some = len(ROW_WORDS) if exact else len(ROW_WORDS) // 2
    words = [digest.hash_word(F.col("_hash"), i) if i < some else F.lit(0).cast("bigint") for i in range(len(ROW_WORDS))]
    return hashed.select(*[column(c) for c in names], *[w.alias(n) for w, n in zip(words, ROW_WORDS, strict=True)])


def _sums(words: Sequence[str], name: str, condition: str) -> list[Column]:
    """Sums of the two halves of each word on one side; exact up to 2**31 rows of a group."""
    halves = [h for w in words for h in (f"shiftrightunsigned({w}, 32)", f"{w} & 4294967295L")]
    return [F.expr(f"coalesce(sum({h}) FILTER (WHERE {condition}), 0L) AS {name}{i}") for i, h in enumerate(halves)]


def _compared(source: DataFrame, target: DataFrame, by: Sequence[str], words: Sequence[str] = ROW_WORDS) -> DataFrame:
    """Row count and hash sums of either side per group, where they differ.

    Both sides go through one aggregation, so a key with very many rows is folded before
    the shuffle and no rows are paired with each other.
    """
    both = source.withColumn("_s", F.lit(True)).unionByName(target.withColumn("_s", F.lit(False)))
    folded = both.groupBy(*by).agg(
        F.expr("count_if(_s) AS n_source"),
        F.expr("count_if(NOT _s) AS n_target"),
        *_sums(words, "s", "_s"),
        *_sums(words, "t", "NOT _s"),
    )
    same = " AND ".join(f"s{i} = t{i}" for i in range(2 * len(words)))
    return folded.where(f"NOT (n_source = n_target AND {same})")


def _unequal_buckets(source: DataFrame, target: DataFrame, words: Sequence[str]) -> list[int]:
    """Buckets whose folded hashes differ: at most as many numbers as there are buckets."""
    return [row["_bucket"] for row in _compared(source, target, ["_bucket"], words).select("_bucket").collect()]


def _surplus(both: DataFrame, hash60: Column, by: Sequence[str], buckets: int | None) -> DataFrame:
    """(by..., side, copies) of a frame of tagged rows, first narrowed to unequal hash buckets."""
    if buckets is not None:
        bucket = F.pmod(hash60, F.lit(buckets))
        folded = both.select(bucket.alias("_bucket"), hash60.alias("_hash"), (F.col("_d") > 0).alias("_s"))
        sides = [folded.where(c).drop("_s") for c in ("_s", "NOT _s")]
        both = both.where(bucket.isin(_unequal_buckets(*sides, ["_hash"])))
    surplus = both.groupBy(*by).agg(F.sum("_d").alias("_d")).where(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, "only_source").otherwise("only_target")
    return surplus.select(*by, side.alias("side"), F.abs("_d").alias("copies"))


def differing_keys(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    buckets: int | None = 256,
    exact: bool = True,
    hashed: bool = False,
) -> DataFrame:
    """(key..., side, n_source, n_target) for each key whose rows differ.

    ``side`` is only_source, only_target or differs. With ``buckets`` set, a first job folds both
    sides per hash bucket of the key and brings back the unequal buckets, at most ``buckets``
    numbers; only their rows are hashed again and shuffled by key. Pass None where most buckets
    are expected to differ: the first job would then only add a scan. ``hashed`` frames hold the
    result of ``differing_rows_of`` already.
    """
    if buckets is not None:
        folded = [
            differing_rows_of(df.withColumn("_bucket", _key_bucket(df, key, buckets)), [], columns, exact, ["_bucket"])
            for df in (source, target)
        ]
        unequal = _unequal_buckets(*folded, ROW_WORDS)
        source, target = (df.where(_key_bucket(df, key, buckets).isin(unequal)) for df in (source, target))
    sides = [source, target] if hashed else [differing_rows_of(df, key, columns, exact) for df in (source, target)]
    side = (
        F.when(F.col("n_target") == 0, "only_source")
        .when(F.col("n_source") == 0, "only_target")
        .otherwise("differs")
    )
    return _compared(*sides, list(key)).select(*key, side.alias("side"), "n_source", "n_target")


def key_sample(differences: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` differing keys in key order, for a report."""
    return differences.orderBy(*key).limit(n)


def multiset_difference(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    decimals: int = FLOAT_DECIMALS,
    numeric_strings: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """(row, side, copies): canonical rows one side holds more often, and how many more.

    With ``buckets``, a first job finds the hash buckets that differ, and only their rows are
    shuffled: right for large frames that are mostly equal.
    """
    texts = [
        df.select(row_text(df, columns, decimals, numeric_strings).alias("row"), F.lit(d).alias("_d"))
        for df, d in ((source, 1), (target, -1))
    ]
    return _surplus(texts[0].unionByName(texts[1]), digest.prefix60(F.md5("row")), ["row"], buckets)


def row_difference(
    source: DataFrame, target: DataFrame, columns: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """(columns..., side, copies): as ``multiset_difference`` on the typed rows themselves."""
    names = list(columns)
    both = source.select(*names, F.lit(1).alias("_d")).unionByName(target.select(*names, F.lit(-1).alias("_d")))
    return _surplus(both, F.shiftrightunsigned(F.xxhash64(*names), 4), names, buckets)


def difference_summary(differences: DataFrame) -> DataFrame:
    """Number of differing keys or rows per side."""
    return differences.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case; names that then collide are an error."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) < len(lowered):
        raise ValueError(f"column names collide when lower-cased: {sorted(df.columns)}")
    return df.toDF(*lowered)


def aligned(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    source_values: dict[str, Column],
    target_values: dict[str, Column],
) -> DataFrame:
    """Both sides of each key in one row, as ``s_`` and ``t_`` columns with counts ``s_n``, ``t_n``.

    A union and one aggregation instead of a full outer join: NULL keys meet, and a key with
    very many rows is folded before the shuffle. Values are only meaningful where the count
    of that side is 1; callers report other counts as duplicates.
    """
    s_types = source.select(*[v.alias(n) for n, v in source_values.items()]).schema
    t_types = target.select(*[v.alias(n) for n, v in target_values.items()]).schema
    frames = []
    for is_source, df, values in ((True, source, source_values), (False, target, target_values)):
        picked = [column(k).alias(k) for k in key] + [F.lit(is_source).alias("_s")]
        for prefix, schema, mine in (("s_", s_types, is_source), ("t_", t_types, not is_source)):
            for f in schema.fields:
                value = values[f.name] if mine else F.lit(None).cast(f.dataType)
                picked.append(value.alias(prefix + f.name))
        frames.append(df.select(*picked))
    both = frames[0].unionByName(frames[1])
    names = [c for c in both.columns if c.startswith(("s_", "t_")) and c not in key]
    return both.groupBy(*key).agg(
        F.count_if(F.col("_s")).alias("s_n"),
        F.count_if(~F.col("_s")).alias("t_n"),
        *[F.max(c).alias(c) for c in names],
    )
