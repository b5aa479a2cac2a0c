"""Bloom filters of built-in functions: bits in a written one-row table, read as a scalar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import settle

# Bits a key and hash functions: about 1 % of other keys pass.
BITS, HASHES = 10, 7


def words_for(n: int) -> int:
    """64-bit words of a filter for n keys."""
    return max(1, -(-n * BITS // 64))


def _spots(key: Column, level: int, words: int) -> list[Column]:
    """Bit numbers of a key: double hashing of two 32-bit halves."""
    mixed = F.xxhash64(key, F.lit(level))
    first, step = F.shiftrightunsigned(mixed, 32), mixed.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
    return [(first + step * i) % (words * 64) for i in range(HASHES)]


def _mask(spot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))


def fill(keys: DataFrame, level: int, words: int) -> DataFrame:
    """One row: the words of a filter of the `key` column. Bits of a word are or-ed in the tasks before any shuffle."""
    spots = keys.select(F.explode(F.array(*_spots(F.col("key"), level, words))).alias("spot"))
    pieces = spots.select(F.shiftright("spot", 6).alias("word"), _mask(F.col("spot")).alias("bits"))
    blank = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = pieces.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return settle(whole.agg(F.transform(ordered, lambda x: x["bits"]).alias("bits")))


def passes(key: Column, level: int, words: int, bits: DataFrame) -> Column:
    """Whether a key may be among those of the filter; true for all that are."""
    filled, passed = bits.scalar(), F.lit(True)
    for spot in _spots(key, level, words):
        passed = passed & (F.get(filled, F.shiftright(spot, 6).cast("int")).bitwiseAND(_mask(spot)) != 0)
    return passed
