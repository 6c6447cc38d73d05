"""Equi-joins. Spark picks broadcast or sort-merge from measured sizes; no side is forced.

Both shapes leave the larger side on the left, where adaptive execution can split a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import all_set, quoted, same_key


def keep_known_keys(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose key occurs in ``other``; null never matches.

    The keys are made distinct first, so map-side aggregation sends each key once per task
    however many rows share it.
    """
    keys = other.select(quoted(other_column).try_cast(df.schema[column].dataType).alias("__key"))
    return df.filter(quoted(column).isNotNull()).join(
        keys.na.drop().distinct(), same_key([column], ["__key"]), "left_semi"
    )


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join on keys with different names; the right key is dropped, repeats are kept."""
    return left.join(right, left[left_key] == right[right_key], "inner").drop(right[right_key])


#: Bits of a Bloom filter for a key, words of 64 bits at most, and bits that a key sets in its word.
KEY_BITS, MOST_WORDS, SET_BITS = 16, 1 << 22, 4


def can_filter(df: DataFrame, on: Sequence[str], count: int) -> bool:
    """Whether ``likely_keys`` may be used: the filter stays below MOST_WORDS, and equal keys have equal hashes."""
    exact = not any(isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)) for k in on)
    return exact and 0 < count * KEY_BITS <= MOST_WORDS * 64


def likely_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], count: int) -> DataFrame:
    """Rows of ``df`` whose key may be one of ``keys`` (about ``count``): all that are, and about one in
    fifty of the others.

    A Bloom filter whose every key has its bits in one word of 64: words are put together by one
    aggregate over the keys, and reach the rows as a broadcast table of at most MOST_WORDS words (see
    ``can_filter``), so rows that match nothing are dropped before any shuffle.
    """
    words = max(1, -(-count * KEY_BITS // 64))

    def hashed(rows: DataFrame) -> DataFrame:
        own = [quoted(k) for k in on]
        rows = rows.withColumns({"__word": F.pmod(F.xxhash64(*own), F.lit(words)), "__h": F.xxhash64(F.lit(7), *own)})
        bits = [F.expr(f"shiftleft(1L, cast(shiftright(__h, {6 * i}) & 63 as int))") for i in range(SET_BITS)]
        return rows.withColumn("__mask", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("__h")

    slim = hashed(keys.select(*[quoted(k) for k in on]).filter(all_set(on)))
    bloom = slim.groupBy(F.col("__word").alias("__at")).agg(F.bit_or("__mask").alias("__bits"))
    hit = (F.col("__word") == F.col("__at")) & (F.col("__mask").bitwiseAND(F.col("__bits")) == F.col("__mask"))
    return hashed(df).join(F.broadcast(bloom), hit, "left_semi").drop("__word", "__mask")


def match_keys(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """How often each key occurs on either side: the match step of an upsert, one row per key.

    Counted by one aggregate over both sides; row pairs are never formed. Rows with a null key
    match nothing and are left out.
    """
    def tagged(df: DataFrame, target_count: int, source_count: int) -> DataFrame:
        return df.select(
            *[quoted(k).alias(k) for k in on],
            F.lit(target_count).alias("t"),
            F.lit(source_count).alias("s"),
        ).na.drop(subset=list(on))

    return (
        tagged(target, 1, 0)
        .unionByName(tagged(source, 0, 1))
        .groupBy(*[quoted(k) for k in on])
        .agg(F.sum("t").alias("target_rows"), F.sum("s").alias("source_rows"))
    )
