"""Clicks in a window that slides over the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WINDOW_SECONDS, SLIDE_SECONDS = 3600, 10


def pane_click_counts(clicks: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Clicks per (pane, ad): ``pane`` is the start of the ``slide`` seconds that a click falls into."""
    pane = F.window("click_time", f"{slide} seconds")
    total = F.sum("click_count") if "click_count" in clicks.columns else F.count(F.lit(1))
    counts = clicks.groupBy(pane.alias("pane"), "ad_id").agg(total.alias("click_count"))
    return counts.select(F.to_date("pane.start").alias("date"), F.col("pane.start").alias("pane"), "ad_id", "click_count")


def sliding_click_counts(panes: DataFrame, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """(ad_id, window_end, click_count): clicks of an ad in the ``window`` seconds before ``window_end``, at every end where that number changes.

    Ends lie ``slide`` seconds apart; between two rows of an ad the number stays that of the earlier one, and before the first it is 0. So every
    slide is answered without a row for each of them.

    A pane adds its clicks at its end and takes them away a window later: two rows for a pane, whatever the ratio of window to slide.
    The running sum is cut into stretches of one window length: within (ad, stretch) there are ``window / slide`` ends at most, and a
    stretch starts from the sum of those before, which has a row for each stretch. So an ad with most of the log is the work of many tasks.
    """
    if window % slide:
        raise ValueError("the window has to be a whole number of slides")
    end = F.unix_seconds("pane") + slide
    changes = panes.select(
        "ad_id",
        F.inline(F.array(F.struct(end.alias("at"), F.col("click_count").alias("change")), F.struct((end + window).alias("at"), (-F.col("click_count")).alias("change")))),
    )
    changes = changes.groupBy("ad_id", "at").agg(F.sum("change").alias("change")).withColumn("stretch", F.floor(F.col("at") / window))
    inside = W.partitionBy("ad_id", "stretch").orderBy("at")
    running = changes.withColumn("within", F.sum("change").over(inside))
    before = W.partitionBy("ad_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = changes.groupBy("ad_id", "stretch").agg(F.sum("change").alias("total"))
    carried = carried.select("ad_id", "stretch", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("carried"))
    counts = running.where("change <> 0").join(carried, ["ad_id", "stretch"])
    return counts.select("ad_id", F.timestamp_seconds("at").alias("window_end"), (F.col("carried") + F.col("within")).alias("click_count"))


def sliding_at(panes: DataFrame, now: str, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """(ad_id, click_count) of the window that ends at the last slide up to ``now``; reads the days of that window only."""
    last = F.floor(F.unix_seconds(F.lit(now).cast("timestamp")) / slide) * slide
    start, end = F.timestamp_seconds(last - window), F.timestamp_seconds(last)
    rows = panes.where(F.col("date").between(F.to_date(start), F.to_date(end)) & (F.col("pane") >= start) & (F.col("pane") < end))
    return rows.groupBy("ad_id").agg(F.sum("click_count").alias("click_count"))
