"""Merging new rows into an existing table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_replace(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``incoming`` wins on equal keys; all other rows stay. ``incoming`` has each key once."""
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(kept)


def upsert_accumulate(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], value: str = "click_count"
) -> DataFrame:
    """The values of equal keys are added up."""
    return existing.unionByName(incoming).groupBy(*keys).agg(F.sum(value).alias(value))
