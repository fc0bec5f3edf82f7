"""Category popularity and the most active sessions in the hottest categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOP_CATEGORIES = 10
TOP_SESSIONS = 10
_COUNTS = ("click_count", "order_count", "pay_count")


def session_categories(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per (session, category), in one pass over the actions.

    Everything about categories is computed from this frame. It is aggregated before any join, so a
    session holding a large share of the log enters the joins as one row per category.
    """
    none = F.array().cast("array<bigint>")
    clicked = F.when(F.col("click_category_id").isNotNull(), F.array("click_category_id")).otherwise(none)
    ordered = F.coalesce("order_category_ids", none)
    paid = F.coalesce("pay_category_ids", none)
    # One list of plain ids per action; an id's place in it tells whether it was clicked, ordered or paid.
    touched = actions.select(
        "session_id",
        F.size(clicked).alias("clicked"),
        (F.size(clicked) + F.size(ordered)).alias("clicked_or_ordered"),
        F.posexplode(F.concat(clicked, ordered, paid)).alias("place", "category_id"),
    )
    place, clicks, orders = F.col("place"), F.col("clicked"), F.col("clicked_or_ordered")
    return touched.groupBy("session_id", "category_id").agg(
        F.count_if(place < clicks).alias("click_count"),
        F.count_if((place >= clicks) & (place < orders)).alias("order_count"),
        F.count_if(place >= orders).alias("pay_count"),
    )


def of_sessions(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """The (session, category) rows of the given sessions."""
    return pairs.join(sessions.select("session_id"), "session_id", "left_semi")


def category_counts(pairs: DataFrame) -> DataFrame:
    """Clicks, orders and payments of every category seen."""
    return pairs.groupBy("category_id").agg(*(F.sum(name).alias(name) for name in _COUNTS))


def top_categories(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The ``n`` hottest by clicks, then orders, then payments; the smaller id wins a tie."""
    return counts.orderBy(*(F.desc(name) for name in _COUNTS), "category_id").limit(n)


def category_session_clicks(pairs: DataFrame) -> DataFrame:
    """Clicks per (category, session); sessions that never clicked the category are left out."""
    return pairs.where(F.col("click_count") > 0).select("category_id", "session_id", "click_count")


def top_sessions(pairs: DataFrame, hottest: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """The ``n`` sessions with most clicks in each hot category; the smaller session id wins a tie.

    ``hottest`` comes from ``top_categories``, whose limit bounds what is broadcast. The pairs are then
    filtered where they are, and the literal rank bound lets Spark keep ``n`` rows per category in every
    map task before the shuffle.
    """
    rank = F.row_number().over(W.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id"))
    hot_ids = F.broadcast(hottest.select("category_id"))
    clicks = category_session_clicks(pairs).join(hot_ids, "category_id", "left_semi")
    return clicks.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")
