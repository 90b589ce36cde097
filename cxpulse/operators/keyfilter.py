"""A runtime filter from one table's keys for the scan of another.

The keys are hashed into a fixed number of bits (a Bloom filter with one hash):
``key_bits`` is one row of ``WORDS`` longs however many keys there are, used as a
scalar subquery. ``may_hold`` is false only for keys that are certainly not among
them, so rows that a later semi-join would drop anyway never reach its shuffle or
the aggregation before it. The semi-join stays: the filter alone may let others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4096  # of 64 bits: 32 KB, good for some 100,000 keys


def _bit(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(64 * words))


def key_bits(keys: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """One row: ``bits``, an array of ``words`` longs."""
    bit = _bit(F.col(column), words)
    held = keys.where(F.col(column).isNotNull()).select(
        F.floor(bit / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("bits"))
    zeros = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    by_word = held.union(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # ``words`` entries, whatever the number of keys
    return by_word.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("bits"))


def may_hold(bits: Column, key: Column, words: int = WORDS) -> Column:
    """Whether ``key`` may be among the keys of ``bits``."""
    bit = _bit(key, words)
    word = F.get(bits, F.floor(bit / 64).cast("int"))
    return F.call_function("shiftright", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def filtered(rows: DataFrame, column: str, keys: DataFrame, key_column: str, words: int = WORDS) -> DataFrame:
    """``rows`` without those whose ``column`` is certainly no key. Keys of
    another type hash differently, then all rows stay."""
    if rows.schema[column].dataType != keys.schema[key_column].dataType:
        return rows
    return rows.where(may_hold(key_bits(keys, key_column, words).scalar(), F.col(column), words))
