"""Bloom-filter semi-join in expressions: rows of a large side that cannot match leave before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
BITS_PER_KEY = 12
# 16 MiB: what the driver and every task hold at most; beyond it the filter lets more through, never less.
MOST_BITS = 1 << 27


def _slots(key: Column, bits: int) -> list[Column]:
    """Bit numbers of a key: four places from one 64-bit hash and a second one."""
    a, b = F.xxhash64(key), F.xxhash64(key, F.lit(17))
    # bits is a power of two, so the low bits are the remainder
    return [(a.bitwiseXOR(F.shiftleft(b, 1 + k * 7)) if k else a).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]


def filter_bits(rows: int) -> int:
    """Bits of a filter for so many keys: a power of two, at most MOST_BITS."""
    bits = 1 << 12
    while bits < min(BITS_PER_KEY * rows, MOST_BITS):
        bits *= 2
    return bits


def bloom_words(right: DataFrame, key: str, bits: int) -> Column:
    """Scalar subquery: the filter of ``right``'s keys as one array of 64-bit words. Bits are joined to words
    before and after one shuffle; ``bits / 64`` words meet in one row."""
    slot = F.explode(F.array(*_slots(F.col(key), bits))).alias("slot")
    set_words = right.where(F.col(key).isNotNull()).select(slot).select(
        F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    set_words = set_words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = right.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(set_words, "word", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
                                 lambda w: w["bits"]).alias("words")).scalar()


def may_match(key: Column, words: Column, bits: int) -> Column:
    """Whether every probe of ``key`` hits a set bit."""
    out = key.isNotNull()
    for slot in _slots(key, bits):
        out = out & (F.bit_get(F.get(words, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def prefiltered(left: DataFrame, right: DataFrame, key: str = "k", rows: int | None = None) -> DataFrame:
    """The rows of ``left`` whose key may be among ``right``'s keys (``rows``: how many rows it has, counted if unknown).

    No row with a partner is lost; of the others about one in a thousand stays, more when the bound on the filter is reached.
    """
    bits = filter_bits(right.count() if rows is None else rows)
    return left.where(may_match(F.col(key), bloom_words(right, key, bits), bits))


def filtered_join(left: DataFrame, right: DataFrame, key: str = "k", how: str = "inner", rows: int | None = None) -> DataFrame:
    """Sort-merge join (``inner``, ``left_semi`` or ``right``) whose left side is filtered before its shuffle."""
    if how not in ("inner", "left_semi", "right"):
        raise ValueError("only joins that drop left rows without a partner can filter them")
    return prefiltered(left, right, key, rows).join(right.hint("merge"), key, how)
