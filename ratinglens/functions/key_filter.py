"""Rows that may have a key among some keys, told by a bitmap of fixed size, so that a join need not shuffle the others.

2^24 bits lie in at most 2^14 rows of 16 longs, 2 MB whatever the number of keys, so the bitmap may be broadcast. With a
million keys six rows in a hundred are kept for nothing; with very many keys all rows are.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD_BITS, _SLOT_BITS = 14, 4        # rows, and longs of 64 bits in each


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << _WORD_BITS + _SLOT_BITS + 6))


def _word(place: Column) -> Column:
    return F.shiftright(place, _SLOT_BITS + 6)


def _slot(place: Column) -> Column:
    return F.shiftright(place, 6).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def may_be_among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` without most of those whose key is not in the column of the same name in ``keys``; null is a key."""
    place = _place(F.col(key))
    placed = keys.select(_word(place).alias("_word"), _slot(place).alias("_slot"), _bit(place).alias("_bit"))
    longs = [F.coalesce(F.bit_or(F.when(F.col("_slot") == i, F.col("_bit"))), F.lit(0)) for i in range(1 << _SLOT_BITS)]
    bitmap = placed.groupBy("_word").agg(F.array(*longs).alias("_longs"))
    found = df.join(F.broadcast(bitmap), _word(place) == F.col("_word"))
    return found.where(F.get("_longs", _slot(place)).bitwiseAND(_bit(place)) != 0).select(df.columns)
