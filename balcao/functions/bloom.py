"""A Bloom filter of bit words in plain columns: built by aggregation, tested inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the most and fewest bits of a filter: 16 MB at most, whatever the number of keys.
KEY_BITS = 16
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 12


def size_for(keys: int) -> int:
    """Bits for a number of keys, a power of two; beyond the bound the filter lets more keys pass, never fewer."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (KEY_BITS * keys - 1).bit_length()))


def _places(key: Column, bits: int) -> list[Column]:
    """Four places from two hashes of a 64-bit key."""
    hashes = (F.xxhash64(key), F.xxhash64(key, F.lit(1)))
    halves = [half for h in hashes for half in (h, F.shiftrightunsigned(h, 32))]
    return [half.bitwiseAND(F.lit(bits - 1).cast("long")) for half in halves]


def build(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row: ``words``, the filter of all ``keys`` as 64-bit words.

    Words are merged on both sides of the shuffle, so what reaches the last task
    is bounded by ``bits``, not by the keys.
    """
    place = keys.select(F.explode(F.array(*_places(F.col(column), bits))).alias("place"))
    word, bit = F.shiftright("place", 6), F.col("place").bitwiseAND(F.lit(63).cast("long")).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    held = place.groupBy(word.alias("id")).agg(F.bit_or(mask).alias("bits"))
    every = keys.sparkSession.range(bits // 64).join(held, "id", "left")
    one = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.transform(F.sort_array(F.collect_list(one)), lambda w: w["bits"]).alias("words"))


def might_hold(words: Column, key: Column, bits: int) -> Column:
    """False for keys that are surely not in the filter."""
    def hit(place: Column) -> Column:
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        return F.call_function("bit_get", word, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

    first, *rest = [hit(p) for p in _places(key, bits)]
    for other in rest:
        first = first & other
    return first
