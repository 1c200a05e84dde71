"""Sums of numbers with all their digits, whatever their scale.

Spark's widest decimal has 38 digits, so a cast cuts what does not fit. Here a number's digits are dealt to blocks of
eighteen, four before the point and four after it, and each block is summed as a decimal of its own; the carries are
resolved once, on the folded row. Exact for numbers of up to 72 digits on either side of the point and 10^9 rows a
task; ``beyond`` counts numbers with more, which are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canon import number_text

DIGITS, BLOCKS = 18, 4
SIDE = DIGITS * BLOCKS
_ONE = "1" + "0" * DIGITS + "BD"


def _spelled(amount: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.IntegralType):
        return amount.cast("string")
    return number_text(amount.cast("string"))


def digit_sums(df: DataFrame, amount: Column) -> DataFrame:
    """One row (row_count, beyond, sums): signed sums of the blocks, highest first; NULL and text that is no number add 0."""
    given = df.select(amount.alias("a"))
    texts = given.select(_spelled(F.col("a"), given.schema["a"].dataType).alias("t"))
    minus = F.col("t").startswith("-")
    body = F.ltrim("t", F.lit("-"))
    parts = texts.select(
        F.when(minus, -1).otherwise(1).cast("bigint").alias("sign"),
        F.substring_index(body, ".", 1).alias("whole"),
        F.when(body.contains("."), F.substring_index(body, ".", -1)).otherwise("").alias("part"),
    )
    fits = (F.length("whole") <= SIDE) & (F.length("part") <= SIDE)
    digits = F.concat(F.lpad("whole", SIDE, "0"), F.rpad("part", SIDE, "0"))
    padded = parts.select("sign", F.when(fits, digits).alias("digits"), (~fits).alias("beyond"))
    blocks = [F.col("sign") * F.substring("digits", 1 + DIGITS * i, DIGITS).cast("bigint") for i in range(2 * BLOCKS)]
    sums = [F.coalesce(F.sum(b.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")) for b in blocks]
    return padded.agg(F.count(F.lit(1)).alias("row_count"), F.count_if("beyond").alias("beyond"), F.array(*sums).alias("sums"))


def _carried(sums: str) -> Column:
    """The blocks with carries resolved: (carry, digits); a negative number leaves a negative carry."""
    return F.expr(
        f"""aggregate(reverse({sums}), named_struct('carry', CAST(0 AS DECIMAL(38,0)), 'digits', ''),
            (acc, x) -> named_struct(
                'carry', CAST((acc.carry + x - pmod(acc.carry + x, {_ONE})) div {_ONE} AS DECIMAL(38,0)),
                'digits', concat(lpad(CAST(CAST(pmod(acc.carry + x, {_ONE}) AS DECIMAL(38,0)) AS STRING), {DIGITS}, '0'), acc.digits)))"""
    )


def sums_text(sums: str) -> Column:
    """The number that a column of ``sums`` stands for, without needless zeros."""
    plus, minus = _carried(sums), _carried(f"transform({sums}, x -> CAST(-x AS DECIMAL(38,0)))")

    def spelled(x: Column) -> Column:
        digits = F.concat(x["carry"].cast("string"), x["digits"])
        before = F.ltrim(F.substring(digits, F.lit(1), F.length(digits) - SIDE), F.lit("0"))
        after = F.rtrim(F.right(digits, F.lit(SIDE)), F.lit("0"))
        whole = F.when(before == "", "0").otherwise(before)
        return F.when(after == "", whole).otherwise(F.concat_ws(".", whole, after))

    return F.when(plus["carry"] >= 0, spelled(plus)).otherwise(F.concat(F.lit("-"), spelled(minus)))


def difference_text(left: str, right: str) -> Column:
    """How far two columns of sums are apart, as a number without sign."""
    apart = f"zip_with({left}, {right}, (x, y) -> CAST(x - y AS DECIMAL(38,0)))"
    return F.ltrim(sums_text(apart), F.lit("-"))
