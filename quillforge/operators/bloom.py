"""Bloom filters of keys: which rows of a large table can have a partner, told in its scan.

A join of a large table with a set of keys shuffles every row of it, contents and all,
though few have a partner. A filter of the keys is a bitmap aggregate: its blocks, of the
size of Spark's own bitmaps, are broadcast, a row looks at the bits of one block, and only
rows that may match go on to the exact join. There are no false negatives. The number of
keys sets the number of blocks, up to a fixed size; with more keys there is no filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.session import stage

# Fixed value: the bits of one of Spark's bitmaps.
BLOCK_BITS = 32_768
#: Bits set per key (each takes 15 of the 64 bits of a hash), and bits a key is given: some 1 in 150 other rows pass.
PROBES, BITS_PER_KEY = 4, 12
#: The most blocks a filter has: 32 MB, broadcast.
MOST_BLOCKS = 8192


def unused(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


@dataclass(frozen=True)
class KeyFilter:
    """``table`` has block and bitmap, a row per block with keys."""

    blocks: int
    table: DataFrame


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks)).cast("int")


def _positions(key: Column) -> list[Column]:
    mixed = F.xxhash64(key, F.lit(PROBES))
    return [F.shiftrightunsigned(mixed, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def key_filter(keys: DataFrame, *on: Column | str, most_blocks: int = MOST_BLOCKS) -> KeyFilter | None:
    """The filter of the rows' keys, which are the columns ``on``; None if there are too many for ``most_blocks``.

    ``keys`` is read twice, so it should be a table rather than a computation. Nulls are a value like others.
    Tasks build their part of each block before anything is shuffled.
    """
    n = keys.count()
    blocks = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    if blocks > most_blocks:
        return None
    hashed = keys.select(F.xxhash64(*on).alias("key")).select(_block(F.col("key"), blocks).alias("block"), F.explode(F.array(*_positions(F.col("key")))).alias("bit"))
    return KeyFilter(blocks, stage(hashed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))))


def probed(df: DataFrame, found: KeyFilter, *on: Column | str) -> tuple[DataFrame, str]:
    """``df`` with a column, and its name, that tells whether a row's key may be among the filter's. Types must be those of the keys."""
    key, block, bitmap, maybe = (unused(f"_bloom_{n}", df) for n in ("key", "block", "bitmap", "maybe"))
    blocks = F.broadcast(found.table.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap)))
    hashed = df.withColumn(key, F.xxhash64(*on)).withColumn(block, _block(F.col(key), found.blocks))

    def is_set(position: Column) -> Column:
        byte = F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position.bitwiseAND(F.lit(7)).cast("int")) == 1

    test = F.col(bitmap).isNotNull()
    for position in _positions(F.col(key)):
        test = test & is_set(position)
    joined = hashed.join(blocks, block, "left")
    return joined.withColumn(maybe, F.coalesce(test, F.lit(False))).select(*df.columns, maybe), maybe


def possible(df: DataFrame, found: KeyFilter | None, *on: Column | str) -> DataFrame:
    """The rows of ``df`` whose key may be among the filter's: all of them without a filter."""
    if found is None:
        return df
    marked, maybe = probed(df, found, *on)
    return marked.where(F.col(maybe)).drop(maybe)


def divided(df: DataFrame, found: KeyFilter | None, *on: Column | str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key may be among the filter's, rows whose key is not). Each half reads ``df`` by itself; without a filter all rows are in the first."""
    if found is None:
        return df, None
    marked, maybe = probed(df, found, *on)
    return marked.where(F.col(maybe)).drop(maybe), marked.where(~F.col(maybe)).drop(maybe)
