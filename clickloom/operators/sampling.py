"""Stratified, reproducible extraction of sessions by start hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.params import DEFAULT_EXTRACT_TOTAL

HOUR = ("date", "hour")
DRAW_PREFIX = 3  # hex digits: each hour is cut at one of 4096 equal slices of the draw


def session_draws(sessions: DataFrame, seed: int) -> DataFrame:
    """Start hour and draw of each session. The draw orders the sessions of an hour at random, always alike."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("session_id")).cast("binary"))
    return sessions.select(
        "session_id",
        "start_time",
        F.to_date("start_time").alias("date"),
        F.hour("start_time").alias("hour"),
        draw.alias("draw"),
    )


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions started per (date, hour)."""
    return (
        sessions.groupBy(F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("hour_sessions"))
    )


def hour_quotas(hours: DataFrame, total: int = DEFAULT_EXTRACT_TOTAL) -> DataFrame:
    """How many sessions to draw in each hour.

    ``total`` is shared evenly over the days, rounding down, and each day's part over its hours in
    proportion to their sessions, rounding down again; never more than the hour has.
    """
    days = hours.agg(F.count_distinct("date").alias("days")).scalar()
    per_day = F.floor(F.lit(total) / days)
    day_sessions = F.sum("hour_sessions").over(W.partitionBy("date"))
    share = F.floor(F.col("hour_sessions").cast("double") / F.col("day_sessions").cast("double") * F.col("per_day"))
    return (
        hours.select(*HOUR, "hour_sessions", day_sessions.alias("day_sessions"), per_day.alias("per_day"))
        .select(
            *HOUR,
            "hour_sessions",
            "day_sessions",
            F.least(share, F.col("hour_sessions")).cast("bigint").alias("quota"),
        )
    )


def extract_cuts(draws: DataFrame, total: int = DEFAULT_EXTRACT_TOTAL) -> DataFrame:
    """For each hour with a quota: the slice of the draw where the quota fills up, and how many to take there."""
    slices = (
        draws.groupBy(*HOUR, F.substring("draw", 1, DRAW_PREFIX).alias("slice"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hours = slices.groupBy(*HOUR).agg(F.sum("n").alias("hour_sessions"))
    upto = F.sum("n").over(W.partitionBy(*HOUR).orderBy("slice"))
    return (
        slices.withColumn("upto", upto)
        .join(hour_quotas(hours, total), list(HOUR))
        .withColumn("cut_take", F.col("quota") - (F.col("upto") - F.col("n")))
        .where(F.col("cut_take").between(1, F.col("n")))
        .select(*HOUR, F.col("slice").alias("cut_slice"), "cut_take")
    )


def random_extract(draws: DataFrame, cuts: DataFrame) -> DataFrame:
    """The drawn sessions: in each hour the ``quota`` smallest draws.

    Whole slices below the cut are taken as they are, without moving them; only the slice at the cut is ranked. An hour
    holding a large share of all sessions is therefore never ranked in one task. ``cuts`` has a row for each hour of the
    task's days, 24 a day, and is broadcast.
    """
    placed = draws.withColumn("slice", F.substring("draw", 1, DRAW_PREFIX)).join(F.broadcast(cuts), list(HOUR))
    rank = F.row_number().over(W.partitionBy(*HOUR, "slice").orderBy("draw", "session_id"))
    below = placed.where(F.col("slice") < F.col("cut_slice"))
    at_cut = placed.where(F.col("slice") == F.col("cut_slice")).withColumn("rank", rank).where("rank <= cut_take")
    kept = ("session_id", "start_time")
    return below.select(*kept).unionByName(at_cut.select(*kept))


def extract_report(extracted: DataFrame, detail: DataFrame) -> DataFrame:
    """The drawn sessions with the words they searched and the categories they clicked.

    ``detail`` holds the drawn sessions' actions; only these are ever gathered into lists.
    """
    sets = detail.groupBy("session_id").agg(
        F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
    )
    return extracted.join(sets, "session_id").select(
        "session_id", "start_time", "search_keywords", "click_category_ids"
    )
