"""Bit arrays of hashed keys: tell on the map side, before any shuffle, what surely has no partner.

A key sets the bit that its hash names.  A row whose bit is not set has no partner; a
row whose bit is set may have one and still has to be joined.  The array is a scalar
subquery: it is computed once, when the plan that tests it runs, and is the same
expression however many keys there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each key (about one sure miss in sixteen goes undetected), and the least and
# most bits of an array; with the most, an array takes 8 MB.
BITS_PER_KEY = 16
LEAST_BITS = 1 << 12
MOST_BITS = 1 << 26


def bits_for(keys: int) -> int:
    """Bits of an array for so many keys: a power of two within the bounds."""
    return min(max(LEAST_BITS, 1 << (max(keys, 1) * BITS_PER_KEY - 1).bit_length()), MOST_BITS)


def place_of(bits: int, *keys: Column) -> Column:
    """The bit that a key sets, of a power of two of bits."""
    return F.xxhash64(*keys).bitwiseAND(F.lit(bits - 1).cast("bigint"))


def bit_array(rows: DataFrame, keys: list[str], bits: int) -> Column:
    """The keys of all rows as an array of 64-bit words."""
    place = F.col("p")
    words = (rows.select(place_of(bits, *[F.col(k) for k in keys]).alias("p"))
             .groupBy(F.shiftright(place, 6).alias("id"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("word")))
    return _in_order(words, bits // 64)


def count_array(rows: DataFrame, keys: list[str], places: int) -> Column:
    """How many rows have a key at each of a power of two of places."""
    counts = rows.select(place_of(places, *[F.col(k) for k in keys]).alias("id")).groupBy("id").agg(F.count("*").alias("word"))
    return _in_order(counts, places)


def _in_order(words: DataFrame, n: int) -> Column:
    """The words of the places (id, word) 0 to n - 1 as one array; 0 where there is none."""
    every = words.sparkSession.range(n).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "word")))
    return every.agg(F.transform(ordered, lambda w: w["word"]).alias("words")).scalar()


def may_hold(words: Column, bits: int, *keys: Column) -> Column:
    """False only where the key of this row is surely not in the array."""
    return has_bit(words, place_of(bits, *keys))


def has_bit(words: Column, place: Column) -> Column:
    """Whether a bit is set.  Spark computes ``place`` twice; in a loop over many rows it should be a column already."""
    word = F.get(words, F.shiftright(place, 6).cast("int"))
    return F.call_function("bit_get", word, place.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1
