"""Drop rows that match nothing before they are shuffled: a Bloom filter in plain columns.

The filter is one value, an array of longs of fixed size, built by a grouped bit_or: a task sends at most
one row for each long, however many keys it has seen. It reaches the other side as the result of a scalar
subquery. A row that the filter lets through may still match nothing; one that matches is never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 5
#: Bits for each expected key: about one in a hundred other keys gets through.
BITS_PER_KEY = 10
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
DEFAULT_BITS = 1 << 22


def bits_for(keys: int) -> int:
    """A power of two with room for so many keys, between 8 KB and 16 MB."""
    return min(max(1 << (BITS_PER_KEY * keys - 1).bit_length() if keys else LEAST_BITS, LEAST_BITS), MOST_BITS)


def _places(columns: list[Column], bits: int) -> list[Column]:
    """The bits of a key, from two hashes of it."""
    first = F.pmod(F.xxhash64(*columns), F.lit(bits))
    step = F.pmod(F.xxhash64(F.lit("step"), *columns), F.lit(bits))
    return [F.pmod(first + F.lit(i) * step, F.lit(bits)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, columns: list[str], bits: int = DEFAULT_BITS) -> Column:
    """The filter over a table's keys, as a value that a condition on any other table can use."""
    place = keys.select(F.explode(F.array(*_places([F.col(c) for c in columns], bits))).alias("place"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    set_bits = place.select(F.shiftright("place", 6).alias("word"), one.alias("bits"))
    none = keys.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_bits.union(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return words.select(F.transform(ordered, lambda w: w.bits).alias("filter")).scalar()


def may_be_in(found: Column, columns: list[Column], bits: int = DEFAULT_BITS) -> Column:
    """False for keys that are surely not in the filter; null keys are in none."""
    held = None
    for place in _places(columns, bits):
        word = F.get(found, F.shiftright(place, 6).cast("int"))
        here = F.getbit(word, (place % 64).cast("int")) == 1
        held = here if held is None else held & here
    for c in columns:
        held = c.isNotNull() & held
    return held
