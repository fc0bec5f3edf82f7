from __future__ import annotations

import pytest

from clickloom.operators import stats
from clickloom.schemas import STEP_BUCKETS, VISIT_BUCKETS

EDGES = [
    (0, None),
    (1, "1s_3s"),
    (3, "1s_3s"),
    (4, "4s_6s"),
    (6, "4s_6s"),
    (7, "7s_9s"),
    (9, "7s_9s"),
    (10, "10s_30s"),
    (30, "10s_30s"),
    (31, "30s_60s"),
    (60, "30s_60s"),
    (61, "1m_3m"),
    (180, "1m_3m"),
    (181, "3m_10m"),
    (600, "3m_10m"),
    (601, "10m_30m"),
    (1800, "10m_30m"),
    (1801, "30m"),
]


def _sessions(spark, *pairs):
    return spark.createDataFrame(list(pairs), "visit_length bigint, step_length bigint")


@pytest.mark.parametrize(("seconds", "bucket"), EDGES)
def test_visit_edges(spark, seconds, bucket):
    row = stats.session_histogram(_sessions(spark, (seconds, 1))).first()
    assert [b for b in VISIT_BUCKETS if row[f"visit_length_{b}"]] == ([bucket] if bucket else [])


@pytest.mark.parametrize(
    ("steps", "bucket"),
    [(1, "1_3"), (3, "1_3"), (4, "4_6"), (6, "4_6"), (7, "7_9"), (9, "7_9"), (10, "10_30"), (30, "10_30")]
    + [(31, "30_60"), (60, "30_60"), (61, "60"), (5000, "60")],
)
def test_step_edges(spark, steps, bucket):
    row = stats.session_histogram(_sessions(spark, (0, steps))).first()
    assert [b for b in STEP_BUCKETS if row[f"step_length_{b}"]] == [bucket]


def test_ratios(spark):
    row = stats.session_aggr_stat(_sessions(spark, (0, 1), (2, 2), (5, 61))).first()
    assert row.session_count == 3
    assert (row.visit_length_1s_3s_ratio, row.visit_length_4s_6s_ratio, row.visit_length_30m_ratio) == (0.33, 0.33, 0)
    assert (row.step_length_1_3_ratio, row.step_length_60_ratio) == (0.67, 0.33)


def test_no_sessions(spark):
    row = stats.session_aggr_stat(_sessions(spark)).first()
    assert row.session_count == 0 and set(row[1:]) == {None}
