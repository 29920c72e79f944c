"""Filtering by a bitmap of fixed size before a join.

A bitmap of hashed keys is a few megabytes however many keys there are, so it
may be broadcast. It lets through every row whose key is among the keys, and few
others while the keys are fewer than its bits; the join that follows is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
_ROW = 32_768


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def maybe_in(rows: DataFrame, key: str, keys: DataFrame, key_of: str, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false only if the key is not among ``keys``."""
    place = _place(F.col(key_of))
    bitmaps = (
        keys.select(
            F.bitmap_bucket_number(place).alias("_bucket"),
            F.bitmap_bit_position(place).alias("_bit"),
        )
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    marked = rows.withColumn("_place", _place(F.col(key))).withColumn(
        "_bucket", F.bitmap_bucket_number("_place")
    )
    found = marked.join(F.broadcast(bitmaps), "_bucket", "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    shifted = F.call_function("shiftright", value, (bit % 8).cast("int"))
    hit = F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return found.withColumn(flag, hit).drop("_place", "_bucket", "_bits")
