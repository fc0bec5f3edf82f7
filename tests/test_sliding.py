from __future__ import annotations

from collections import Counter

import pytest

from clickloom.operators import sliding


def brute(clicks, window, slide):
    """The clicks before every slide's end from the first to the last that has any."""
    ends = range(min(t for _, t in clicks) // slide * slide + slide, max(t for _, t in clicks) + window + 2 * slide, slide)
    return {(ad, end): sum(a == ad and end - window <= t < end for a, t in clicks) for ad in {a for a, _ in clicks} for end in ends}


@pytest.mark.parametrize(("window", "slide"), [(60, 10), (30, 30), (20, 10)])
def test_every_slide_is_answered(spark, window, slide):
    clicks = [(i % 3, 1704067200 + (i * i * 7) % 400 - 100) for i in range(80)]
    log = spark.createDataFrame(clicks, "ad_id bigint, t bigint").selectExpr("ad_id", "timestamp_seconds(t) as click_time")
    panes = sliding.pane_click_counts(log, slide)
    found = {(r.ad_id, int(r.at)): r.click_count for r in sliding.sliding_click_counts(panes, window, slide).selectExpr("ad_id", "unix_seconds(window_end) as at", "click_count").collect()}
    want = brute(clicks, window, slide)
    for ad in range(3):
        now = 0
        for end in sorted(e for a, e in want if a == ad):
            changed = want[ad, end] != now
            now = want[ad, end]
            assert ((ad, end) in found) == changed
            assert found.get((ad, end), now) == now
    assert len(found) == len({k for k in found if k in want})


def test_one_moment(spark):
    log = spark.createDataFrame([(1, "2024-01-01 23:30:01"), (1, "2024-01-02 00:10:00"), (2, "2024-01-02 00:29:59"), (2, "2024-01-02 00:30:00")], "ad_id bigint, t string")
    panes = sliding.pane_click_counts(log.selectExpr("ad_id", "cast(t as timestamp) as click_time"))
    assert dict(map(tuple, sliding.sliding_at(panes, "2024-01-02 00:30:07").collect())) == {1: 2, 2: 1}
    assert dict(map(tuple, sliding.sliding_at(panes, "2024-01-02 00:30:10").collect())) == {1: 1, 2: 2}
    with pytest.raises(ValueError, match="whole number"):
        sliding.sliding_click_counts(panes, 3600, 7)


def test_a_hot_ad_is_cut_in_time(spark, plan):
    log = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 3 = 0, 0, id % 50) as ad_id", "timestamp_seconds(1704067200 + id * 6) as click_time")
    counts = sliding.sliding_click_counts(sliding.pane_click_counts(log))
    text = plan(counts)
    assert "window(click_time" not in text.replace("window_end", "") or "Expand" not in text
    stretches = [line for line in text.splitlines() if "Window [" in line]
    assert any("stretch" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in stretches)
    ends = counts.selectExpr("ad_id", "unix_seconds(window_end) div 3600 as hour").collect()
    # what a task holds of the hot ad at once is an hour, 360 slides at most
    assert max(Counter(map(tuple, ends)).values()) <= 360
    last = {r.ad_id: r.click_count for r in counts.orderBy("window_end").collect()}
    assert set(last.values()) == {0}
