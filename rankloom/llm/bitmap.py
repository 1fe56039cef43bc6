"""A bit map of keys, against which rows are tested where they lie.

Before a join that few rows of a large table will meet, the map lets most of
the others pass by without a shuffle.  A row whose key is in the map may be a
stranger with the same bit, so the join decides; a row whose key is not is
certain.  The map has 16 bits a key and 2**26 (8 MB) at most, whatever the
table; beyond that more strangers go through the join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 16, 26


def bit_map(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test for key columns: whether a row's key may be among the different, stored ``keys``."""
    count = max(1, keys.count())
    size = min(MOST_BITS, max(LEAST_BITS, (16 * count - 1).bit_length()))
    place = lambda column: F.shiftrightunsigned(F.xxhash64(column, F.lit(size)), 64 - size)
    word, bit = (lambda p: F.shiftright(p, 6)), (lambda p: F.pmod(p, F.lit(64)).cast("int"))
    set_ = keys.select(place(F.col(key)).alias("p"))
    set_ = set_.select(word(F.col("p")).alias("id"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(F.col("p"))).alias("bits"))
    set_ = set_.groupBy("id").agg(F.bit_or("bits").alias("bits"))
    every = keys.sparkSession.range(1 << (size - 6)).join(set_, "id", "left")
    # One row of 2**(size - 6) numbers, made once for the plan that uses it.
    words = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("w"))
    held = words.select(F.transform("w", lambda w: w["bits"]).alias("w")).scalar()

    def test(column: Column) -> Column:
        p = place(column)
        return F.call_function("shiftrightunsigned", F.get(held, word(p).cast("int")), bit(p)).bitwiseAND(F.lit(1)) == 1

    return test
