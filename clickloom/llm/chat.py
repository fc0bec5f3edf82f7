"""Logged conversations: drop those that are the beginning of a longer one, then format what is left.

A chat service that logs the conversation so far at each turn leaves every conversation many times over. Each turn
gets the rolling hash of all turns up to it: the sum of the hashes of (turn, role, text), modulo 2**64, which needs no
order among the rows that are summed. A conversation whose last rolling hash is that of an inner turn of another one is
its beginning; an anti-join drops it. Of conversations that are equal throughout the smallest id stays.

Sums run over pieces of ``PIECE`` turns first and over pieces then, so that a conversation with a third of all rows is not
one task's work. Rows with a null turn or null id take no part. A null role or text counts as empty. Rows
equal in id, turn, role and text count once; several rows of one turn are taken in the order of role and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import scratch_path, stored

PIECE = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def clean_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), each row once."""
    return (
        turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
        .select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct()
    )


def _turn_hash() -> list[Column]:
    """Two 31-bit hashes of a turn; a sum of a billion of them stays within 64 bits."""
    h = F.xxhash64("turn", "role", "text")
    return [h.bitwiseAND(F.lit(0x7FFFFFFF)).alias("low"), F.shiftrightunsigned(h, 33).alias("high")]


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, n, low, high): of each turn number, how many rows up to it and the sums of their hashes."""
    cells = turns.select("conv_id", "turn", *_turn_hash()).groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    cells = cells.withColumn("piece", F.floor(F.col("turn") / PIECE))
    pieces = cells.groupBy("conv_id", "piece").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "low", "high")))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "piece", *(F.coalesce(F.sum(f"all_{c}").over(before), F.lit(0)).alias(f"old_{c}") for c in ("n", "low", "high")))
    inside = Window.partitionBy("conv_id", "piece").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.select("conv_id", "piece", "turn", *(F.sum(c).over(inside).alias(c) for c in ("n", "low", "high")))
    return sums.join(pieces, ["conv_id", "piece"]).select("conv_id", "turn", *((F.col(c) + F.col(f"old_{c}")).alias(c) for c in ("n", "low", "high")))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are not the beginning of another; ``turns`` as of clean_turns."""
    rolling = stored(rolling_hashes(turns), scratch_path(turns.sparkSession, "rolling"))
    key = ["n", "low", "high"]
    whole = rolling.groupBy("conv_id").agg(F.max_by(F.struct(*key), "turn").alias("k")).select("conv_id", "k.*")
    whole = stored(whole, scratch_path(turns.sparkSession, "whole"))
    first = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    inner = rolling.join(whole.select("conv_id", F.col("n").alias("of")), "conv_id").where("n < of").select(*key).distinct()
    return first.join(inner, key, "left_anti").select("conv_id", F.col("n").alias("n_turns"))


def formatted_turns(turns: DataFrame) -> DataFrame:
    """The turns of maximal conversations with their text in the chat template.

    (conv_id, n_turns, turn, role, rendered); joined in the order of turn, role and text, the rendered
    pieces of a conversation are its formatted text.
    """
    turns = stored(clean_turns(turns), scratch_path(turns.sparkSession, "turns"))
    kept = stored(maximal_conversations(turns), scratch_path(turns.sparkSession, "maximal"))
    piece = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(f"{CLOSE}\n"))
    return turns.join(kept, "conv_id").select("conv_id", "n_turns", "turn", "role", piece.alias("rendered"))
