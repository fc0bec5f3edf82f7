"""Exact duplicates by two passes of a Bloom filter; DataFrame functions only.

Pass 1 reduces every text to a cell (block, mask): a block number and four bits of a 64-bit word, both from one
64-bit hash. Cells are counted with partial aggregation; the masks of cells that occur twice or more are OR-ed
by block: a register-blocked Bloom filter of the possibly repeated hashes. Equal texts have equal cells,
so none is missed. Pass 2 tests each row against the filter. Rows that fail stand alone and pass
straight through; only the others shuffle, by SHA-256, to find their group.

The filter has at most ``bloom.MAX_BLOCKS`` words (two texts a word below that), which bounds the broadcast. Beyond, more
single texts pass the test and are shuffled; the result is the same.

A null text counts as empty. Of equal texts the largest id stays (a null id only in a group without others). Rows
that are equal in both id and text count in ``group_size`` and are all marked as kept by ``mark_copies``;
``without_copies`` leaves one of them. Names of extra columns may be any but those that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import bloom
from clickloom.session import scratch_path, stored

_SHA = "__sha256"


def _text_bytes(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")


def repeat_filter(docs: DataFrame, text_col: str, blocks: int) -> DataFrame:
    """The filter of the cells that occur twice; at most ``blocks`` rows."""
    cells = docs.select(*bloom.cell(F.xxhash64(_text_bytes(text_col)), blocks)).groupBy(bloom.BLOCK, bloom.MASK).agg(F.count(F.lit(1)).alias("n"))
    return bloom.key_filter(cells.where("n > 1"))


def split_by_filter(docs: DataFrame, text_col: str, most_blocks: int = bloom.MAX_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Rows of texts that stand alone, and rows that may have copies; both with the column ``__sha256``."""
    blocks = bloom.block_count(docs.count(), most_blocks)
    bits = stored(repeat_filter(docs, text_col, blocks), scratch_path(docs.sparkSession, "repeats"))
    text = _text_bytes(text_col)
    marked = bloom.tested(docs, F.xxhash64(text), bits, blocks, "__maybe")
    tidy = lambda df: df.withColumn(_SHA, F.sha2(text, 256)).drop("__maybe")
    return tidy(marked.where(~F.col("__maybe"))), tidy(marked.where("__maybe"))


def _groups(repeated: DataFrame, id_col: str) -> DataFrame:
    """(hash, largest id, size) of every group among the rows that may have copies, as a written table.

    A table, because adaptive execution then splits a group that holds much of the rows when they are joined to it.
    """
    groups = repeated.groupBy(_SHA).agg(F.max(f"`{id_col}`").alias("__keep"), F.count(F.lit(1)).alias("__size"))
    return stored(groups, scratch_path(repeated.sparkSession, "copies"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    alone, repeated = split_by_filter(docs.select(f"`{id_col}`", f"`{text_col}`"), text_col, most_blocks)
    alone = alone.select(F.col(f"`{id_col}`"), F.col(f"`{id_col}`").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), F.col(_SHA).alias("text_sha256"))
    repeated = repeated.select(f"`{id_col}`", _SHA)
    grouped = repeated.join(_groups(repeated, id_col), _SHA).select(
        F.col(f"`{id_col}`"),
        F.col("__keep").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col(f"`{id_col}`").eqNullSafe(F.col("__keep")).alias("kept"),
        F.col(_SHA).alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the largest id."""
    alone, repeated = split_by_filter(docs, text_col, most_blocks)
    groups = _groups(repeated.select(f"`{id_col}`", _SHA), id_col).select(F.col(_SHA).alias("__of"), "__keep")
    same = F.col(_SHA).eqNullSafe(F.col("__of")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__keep"))
    kept = repeated.join(groups, same, "left_semi").dropDuplicates([_SHA])
    return alone.drop(_SHA).unionByName(kept.drop(_SHA))
