"""Bloom filters as small tables of 4 KB blocks, built and read with SQL functions only.

A key picks one block and two bits in it. A filter is a table (block, bits); it is
broadcast, and its size is bounded: ``MAX_BLOCKS`` blocks of 4 KB are 64 MB whatever the
number of keys. Beyond about 30 million keys it fills up: more keys pass than must, none is
missed, so what follows stays exact and only moves more rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32768
MAX_BLOCKS = 16384
BITS_PER_KEY = 16


def blocks_for(keys: int) -> int:
    """Blocks for so many keys at 16 bits each, within the bound."""
    return min(MAX_BLOCKS, max(1, -(-keys * BITS_PER_KEY // BITS)))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("bigint")


def _bits(key: Column) -> tuple[Column, Column]:
    """Two different bits of a block."""
    mixed = F.xxhash64(key, F.lit(1))
    first = mixed.bitwiseAND(BITS - 1)
    step = F.shiftrightunsigned(mixed, 20).bitwiseAND(BITS // 2 - 1) + 1
    return first, (first + step).bitwiseAND(BITS - 1)


def _cells(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    block = _block(F.col(key), blocks)
    return keys.select(
        F.explode(F.array(*[block * BITS + bit for bit in _bits(F.col(key))])).alias("cell")
    )


def _as_filter(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.expr(f"cell div {BITS}").alias("block")).agg(
        F.expr(f"bitmap_construct_agg(cell % {BITS})").alias("bits")
    )


def seen(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of the keys that occur."""
    return _as_filter(_cells(keys, key, blocks))


def seen_twice(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of the keys that may occur twice: the cells that two rows or more have hit.

    Rows of a task that hit the same cell are counted together before they move, so what
    moves is one number per cell and task, whatever the size of a group of equal keys.
    """
    counts = _cells(keys, key, blocks).groupBy("cell").agg(F.count(F.lit(1)).alias("hits"))
    return _as_filter(counts.filter("hits > 1"))


def flagged(df: DataFrame, bloom: DataFrame, key: Column, blocks: int, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: whether the filter may contain ``key``. Rows stay in place."""
    table = F.broadcast(bloom.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    at = df.withColumn("__at", _block(key, blocks))
    joined = at.join(table, F.col("__at") == F.col("__block"), "left")

    def bit_set(bit: Column) -> Column:
        byte = F.substring(F.col("__bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("bigint")
        return F.getbit(value, bit.bitwiseAND(7).cast("int")) == 1

    first, second = _bits(key)
    found = F.coalesce(bit_set(first) & bit_set(second), F.lit(False))
    return joined.withColumn(name, found).drop("__at", "__block", "__bits")
