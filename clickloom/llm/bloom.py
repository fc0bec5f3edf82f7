"""A register-blocked Bloom filter in DataFrame functions.

A 64-bit hash becomes a cell: a block number and a mask of up to four bits of a 64-bit word. A filter is a table of (block, bits); it has as
many rows as blocks at most, which bounds the broadcast. A key that is in the filter is always found; of others a few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 21
BLOCK, MASK, BITS = "__block", "__mask", "__bits"


def block_count(keys: int, most: int = MAX_BLOCKS) -> int:
    """Two keys a word, up to the bound."""
    return max(1, min(most, keys // 2))


def cell(h: Column, blocks: int) -> tuple[Column, Column]:
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int")) for at in (40, 46, 52, 58)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return F.pmod(h, F.lit(blocks).cast("bigint")).alias(BLOCK), mask.alias(MASK)


def key_filter(cells: DataFrame) -> DataFrame:
    """The filter of a table of cells."""
    return cells.groupBy(BLOCK).agg(F.bit_or(MASK).alias(BITS))


def tested(df: DataFrame, h: Column, bits: DataFrame, blocks: int, found: str) -> DataFrame:
    """``df`` with the boolean ``found``: false only where the key is surely not in the filter."""
    block, mask = cell(h, blocks)
    out = df.withColumn(BLOCK, block).withColumn(MASK, mask).join(F.broadcast(bits), BLOCK, "left")
    hit = F.coalesce(F.col(BITS).bitwiseAND(F.col(MASK)) == F.col(MASK), F.lit(False))
    return out.withColumn(found, hit).drop(BLOCK, MASK, BITS)
