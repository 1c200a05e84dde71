"""Masking that keeps the shape of a text and keeps joins.

Under one key and domain, masking permutes the texts of a shape: digits become digits, capital letters A-Z capital
letters, small letters a-z small letters, and all other characters stay where they are. Equal texts get equal masks and
different texts different ones, so masked keys join, group and count as the plain ones did. ``unmask`` needs the key.

The permutation is a Feistel network over the characters: in each round one half is shifted, character by character
within its class, by a hash of the key, the round and the other half. It hides values from who reads a masked table; the
length, the classes and the frequency of a value still show.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Even, so that both halves end where they were.
ROUNDS = 8
#: (first code, number of characters) of each class.
CLASSES = ((48, 10), (65, 26), (97, 26))
#: Characters shifted by one hash, each by eight of its hexadecimal digits.
BLOCK = 8


def _moved(char: Column, shift: Column) -> Column:
    code, out = F.ascii(char), char
    for first, size in CLASSES:
        moved = F.chr(F.pmod(code - first + shift, F.lit(size).cast("bigint")) + first)
        out = F.when(code.between(first, first + size - 1), moved).otherwise(out)
    return out


def _shifted(half: Column, other: Column, turn: Column, secret: str, sign: int) -> Column:
    """``half`` shifted by what ``other`` and the round say."""
    last = F.floor(F.greatest(F.char_length(half) - 1, F.lit(0)) / BLOCK).cast("int")
    block = lambda j: F.sha2(F.concat_ws(":", F.lit(secret), turn.cast("string"), j.cast("string"), other), 256)
    stream = F.array_join(F.transform(F.sequence(F.lit(0), last), block), "")
    amount = lambda s, i: F.conv(F.substring(s, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint") * sign
    shift = lambda s: F.array_join(F.transform(F.split(half, ""), lambda c, i: _moved(c, amount(s, i))), "")
    # one hash stream for all characters: an array of one binds it
    return F.element_at(F.transform(F.array(stream), shift), 1)


def _permuted(text: Column, cut: Column, turns: Column, step) -> Column:
    halves = F.struct(F.left(text, cut).alias("a"), F.substr(text, cut + 1).alias("b"))
    return F.when(text.isNotNull(), F.aggregate(turns, halves, step, lambda s: F.concat(s["a"], s["b"])))


def mask(col: Column, key: str, domain: str = "") -> Column:
    """The text of ``col`` under the permutation of ``key`` and ``domain``; NULL stays NULL.

    Numbers are masked by their digits and come back as text, as a mask may begin with zeros. Columns that join must
    share their domain.
    """
    secret, text = f"{key}:{domain}", col.cast("string")
    step = lambda s, r: F.struct(s["b"].alias("a"), _shifted(s["a"], s["b"], r, secret, 1).alias("b"))
    return _permuted(text, F.floor(F.char_length(text) / 2).cast("int"), F.sequence(F.lit(0), F.lit(ROUNDS - 1)), step)


def unmask(col: Column, key: str, domain: str = "") -> Column:
    """The text that ``mask`` made ``col`` of."""
    secret, text = f"{key}:{domain}", col.cast("string")
    step = lambda s, r: F.struct(_shifted(s["b"], s["a"], r, secret, -1).alias("a"), s["a"].alias("b"))
    return _permuted(text, F.floor(F.char_length(text) / 2).cast("int"), F.sequence(F.lit(ROUNDS - 1), F.lit(0)), step)
