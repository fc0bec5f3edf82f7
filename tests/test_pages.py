from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators import pages
from clickloom.session import scratch_path


def _actions(spark, rows):
    frame = spark.createDataFrame(rows, "session_id string, page_id bigint, t string")
    return frame.selectExpr("session_id", "page_id", "cast(t as timestamp) as action_time")


def test_jumps_cross_hours_and_not_sessions(spark, rows):
    log = [("a", 1, "2024-01-01 00:59:00"), ("a", 2, "2024-01-01 01:00:00"), ("a", 3, "2024-01-01 05:00:00"), ("a", 3, "2024-01-01 05:00:00"), ("b", 1, "2024-01-01 00:00:00")]
    jumps = pages.page_jumps(_actions(spark, log))
    assert rows(jumps, "page_id", "next_page", "jumps") == [(1, 2, 1), (2, 3, 1), (3, 3, 1)]
    rates = pages.page_conversion(_actions(spark, log), (1, 2, 3, 4, 5)).orderBy("step").collect()
    assert [(r.jumps, r.base, r.rate) for r in rates] == [(1, 2, 0.5), (1, 1, 1.0), (0, 1, 0.0), (0, 0, None)]
    assert pages.page_conversion(_actions(spark, log), (1,)).count() == 0


def _hot_log(spark, n=60_000):
    """A third of all views in one hour of one session."""
    second = "timestamp_seconds(1704067200 + if(id % 3 = 0, id * 3600 div 60000, id * 60))"
    return spark.range(0, n, 1, 4).selectExpr("if(id % 3 = 0, 'hot', concat('s', id % 500)) as session_id", "id * 7 % 11 as page_id", f"{second} as action_time")


def test_a_hot_hour_is_cut_by_ranges(spark, rows, plan):
    log = _hot_log(spark)
    jumps = pages.page_jumps(log, partitions=16)
    text = plan(jumps)
    assert "rangepartitioning(session_id" in text and "hashpartitioning(session_id" not in text
    by_session = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    pairs = log.select("page_id", F.lead("page_id").over(by_session).alias("next_page")).where("next_page is not null")
    assert rows(jumps) == rows(pairs.groupBy("page_id", "next_page").count())
    sizes = [r["count"] for r in log.repartitionByRange(16, "session_id", "action_time", "page_id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 60_000 / 16


def test_ranges_of_one_view_and_null_pages(spark, rows):
    log = [("a", p, f"2024-01-01 00:00:{i:02d}") for i, p in enumerate((1, None, 2, 3, 3))] + [(None, 4, "2024-01-01 00:00:00"), (None, 5, "2024-01-01 00:00:01"), ("b", 6, None)]
    for partitions in (1, 3, 32):
        assert rows(pages.page_jumps(_actions(spark, log), partitions)) == [(2, 3, 1), (3, 3, 1), (4, 5, 1), (None, 2, 1)]


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        conf = {"spark.master": "yarn"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
