"""Bloom filters of key columns as a small table, tested by a broadcast join before a shuffle.

The filter is dealt into parts of 2^15 bits. One hash of the key names its part, others the
bits in it, so a row is tested with one part. Parts are built by a bit aggregate in Spark and
nothing of them passes the driver. There are ``MOST_PARTS`` at most (64 MB), whatever the number of
keys: with more keys than that is good for, more rows pass that the join behind the filter drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BITS = 1 << 15
BITS_PER_KEY = 16
BITS_SET = 4
MOST_PARTS = 1 << 14


def parts_for(keys: int, most: int = MOST_PARTS) -> int:
    return max(1, min(most, -(-keys * BITS_PER_KEY // PART_BITS)))


def _part(on: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(parts).cast("long"))


def _places(on: list[str]) -> list[Column]:
    """Places of a key's bits in its part, 15 bits each of a second hash."""
    second = F.xxhash64(F.lit("places"), *on)
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(PART_BITS - 1)) for i in range(BITS_SET)]


def bloom(keys: DataFrame, on: list[str], parts: int) -> DataFrame:
    """(_part, _bits): the filter of the keys ``on`` in ``parts`` parts; parts without keys have no row."""
    placed = keys.dropna(subset=on).select(_part(on, parts).alias("_part"), F.explode(F.array(*_places(on))).alias("_place"))
    return placed.groupBy("_part").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def may_be_in(df: DataFrame, keys: DataFrame, on: list[str], n_keys: int) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys``, of which there are about ``n_keys``: all that are, and
    few others. No row is shuffled. Null keys are in no filter."""
    parts = parts_for(n_keys)
    found = df.withColumn("_part", _part(on, parts)).join(F.broadcast(bloom(keys, on, parts)), "_part")
    held = F.lit(True)
    for place in _places(on):
        byte = F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
        bit = F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("int")
        held = held & (F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0)
    set_ = F.lit(True)
    for key in on:
        set_ = set_ & F.col(key).isNotNull()
    return found.filter(set_ & held).select(*df.columns)
