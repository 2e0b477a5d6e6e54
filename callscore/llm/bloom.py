"""A Bloom filter of fixed size as a small table of bitmaps, in DataFrame functions only.

A hash has two cells in the filter. The filter is at most bits / 32768 rows of
4 KiB, whatever goes into it, so it may be broadcast; when it fills up, more
rows are possibly in it, and none is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ref, temp_names

#: bits of the filter: at most FILTER_BITS / 8 bytes (16 MiB) are broadcast, whatever the input
FILTER_BITS = 1 << 27
_BITMAP_BITS = 32768    # of one row that bitmap_construct_agg makes


def cells(hashed: Column, bits: int = FILTER_BITS) -> Column:
    """The two cells of a 64-bit hash, as an array."""
    if bits < _BITMAP_BITS or bits & (bits - 1):
        raise ValueError("the filter's bits must be a power of two, at least 32768")
    mask = F.lit(bits - 1)
    return F.array(hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask))


def bitmaps(set_cells: DataFrame) -> DataFrame:
    """bucket, bitmap of the cells in column ``cell``."""
    at = set_cells.select(F.bitmap_bucket_number("cell").alias("bucket"), F.bitmap_bit_position("cell").alias("position"))
    # dealt by bucket first: a partial bitmap of every bucket from every task would be far more
    return at.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))


def _is_set(bitmap: str, position: Column) -> Column:
    byte = F.substring(F.col(bitmap), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    bit = F.pow(F.lit(2), position % 8).cast("int")
    return F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0, F.lit(False))


def possibly_in(df: DataFrame, hashed: Column, filled: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add the boolean ``flag``: false only for rows whose hash is not in the
    filter ``filled``. No shuffle."""
    names = temp_names(df, "cells", "bucket0", "bucket1", "bitmap0", "bitmap1")
    pair, test = names[0], F.lit(True)
    out = df.withColumn(pair, cells(hashed, bits))
    for i in (0, 1):
        one = F.broadcast(filled.select(F.col("bucket").alias(names[1 + i]), F.col("bitmap").alias(names[3 + i])))
        cell = F.get(F.col(pair), F.lit(i))
        out = out.join(one, F.bitmap_bucket_number(cell) == F.col(names[1 + i]), "left")
        test = test & _is_set(names[3 + i], F.bitmap_bit_position(cell))
    return out.select(*[ref(c) for c in df.columns], test.alias(flag))
