"""Rows of keys that are not wanted dropped ahead of a shuffle, by a Bloom filter.

The filter is a bit set in one array of 64-bit numbers, built by aggregation
from the wanted keys and read by every scan task as a scalar subquery. All bits
of a key lie in one number. A wanted key always passes; of the others a small share does, so a join or semi-join must
still follow where that matters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
PROBES = 5  # bits set for a key: one or two unwanted keys in a hundred pass at ten bits a key
#: The largest filter sent to the tasks: 16 MB, enough for 13 million keys.
MAX_BITS = 1 << 27
_LEAST_BITS = 1 << 10


def filter_bits(keys: int, max_bits: int = MAX_BITS) -> int | None:
    """Bits (a power of two) of a filter of so many keys; None if more than ``max_bits``."""
    bits = _LEAST_BITS
    while bits < keys * BITS_PER_KEY:
        bits *= 2
    return bits if bits <= max_bits else None


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """The word of a key and its bits there, from two halves of one hash."""
    whole = F.xxhash64(key)
    at = whole.bitwiseAND(F.lit((bits >> 6) - 1))
    places = [F.shiftrightunsigned(whole, 32 + 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(PROBES)]
    # F.shiftleft takes no column as its distance.
    return at, reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def bloom_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, ``words``: the bit set of the values of ``key``, 64 bits a number.

    Equal words combine before the shuffle; all that reaches the last task is
    ``bits`` / 64 numbers, whatever the number of keys.
    """
    at, word = _place(F.col(f"`{key}`").cast("long"), bits)
    given = keys.where(F.col(f"`{key}`").isNotNull()).select(at.alias("at"), word.alias("word"))
    none = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    words = given.unionByName(none).groupBy("at").agg(F.bit_or("word").alias("word"))
    return words.agg(F.array_sort(F.collect_list(F.struct("at", "word")))["word"].alias("words"))


def might_hold(words: Column, key: Column, bits: int) -> Column:
    """Whether a filter may hold a key: always true for one it was built from.

    ``words`` stands here once: where it is a subquery, every mention of it sends
    the whole filter along with the tasks.
    """
    at, word = _place(key.cast("long"), bits)
    return F.bitwise_not(F.get(words, at.cast("int"))).bitwiseAND(word) == 0


def keep_wanted(facts: DataFrame, wanted: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``facts`` less nearly all rows whose whole-number ``key`` is not among ``wanted``.

    Every row with a wanted key stays; rows without a key go; one or two in a
    hundred of the other keys pass, for the join that follows to drop. With
    more wanted keys than the largest filter serves, only rows without a key go.
    ``wanted`` is counted here and read again for the filter, so it should be
    cheap to read.
    """
    keyed = facts.where(F.col(f"`{key}`").isNotNull())
    bits = filter_bits(wanted.count(), max_bits)
    if bits is None:
        return keyed
    words = bloom_filter(wanted.select(f"`{key}`"), key, bits).scalar()
    return keyed.where(might_hold(words, F.col(f"`{key}`"), bits))
