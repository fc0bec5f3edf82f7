"""How sessions spread over visit lengths and step lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.values import ratio
from clickloom.schemas import STEP_BUCKETS, VISIT_BUCKETS

# Inclusive bounds of each bucket, in whole seconds and in actions.
_SHORT = ((1, 3), (4, 6), (7, 9), (10, 30), (31, 60))
VISIT_BOUNDS = dict(zip(VISIT_BUCKETS, (*_SHORT, (61, 180), (181, 600), (601, 1800), (1801, None))))
STEP_BOUNDS = dict(zip(STEP_BUCKETS, (*_SHORT, (61, None))))


def _in(column: str, low: int, high: int | None) -> Column:
    return F.col(column) >= low if high is None else F.col(column).between(low, high)


def session_histogram(sessions: DataFrame) -> DataFrame:
    """One row: the session count and the number of sessions in each bucket.

    A visit of zero seconds is in no visit bucket.
    """
    counts = [F.count(F.lit(1)).alias("session_count")]
    for column, bounds in (("visit_length", VISIT_BOUNDS), ("step_length", STEP_BOUNDS)):
        counts += [F.count_if(_in(column, *edge)).alias(f"{column}_{name}") for name, edge in bounds.items()]
    return sessions.agg(*counts)


def session_aggr_stat(sessions: DataFrame) -> DataFrame:
    """One row: the session count and each bucket's share of it, to two decimals."""
    names = [f"visit_length_{b}" for b in VISIT_BUCKETS] + [f"step_length_{b}" for b in STEP_BUCKETS]
    total = F.col("session_count")
    return session_histogram(sessions).select(
        total, *(ratio(F.col(name), total).alias(f"{name}_ratio") for name in names)
    )
