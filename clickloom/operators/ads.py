"""Ad-click analytics. Batch and streaming jobs call the same functions.

A "clicks" argument is either parsed click rows or any finer count with a ``click_count`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import times

BLACKLIST_THRESHOLD = 100  # clicks of one user on one ad in one day
TOP_ADS = 3


def _counted(clicks: DataFrame, *keys: str | Column) -> DataFrame:
    total = F.sum("click_count") if "click_count" in clicks.columns else F.count(F.lit(1))
    return clicks.groupBy(*keys).agg(total.alias("click_count"))


def click_cells(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, user, ad): the finest count all daily tables add up from."""
    return _counted(clicks, "date", "province", "city", "user_id", "ad_id")


def user_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad)."""
    return _counted(clicks, "date", "user_id", "ad_id")


def over_clicking_users(user_counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who reached ``threshold`` clicks on some ad on some day, each once."""
    return user_counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def without_users(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users who are not blacklisted. Like any list to join with, the blacklist is best read from a table."""
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def city_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad)."""
    return _counted(clicks, "date", "province", "city", "ad_id")


def province_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, ad)."""
    return _counted(clicks, "date", "province", "ad_id")


def province_top_ads(province_counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """The ``n`` most clicked ads of each day and province; the smaller ad id wins a tie."""
    rank = F.row_number().over(W.partitionBy("date", "province").orderBy(F.desc("click_count"), "ad_id"))
    return province_counts.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def minute_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (minute, ad), by click time."""
    minute = F.col("minute.start")
    return _counted(clicks, F.window("click_time", "1 minute").alias("minute"), "ad_id").select(
        F.to_date(minute).alias("date"),
        times.hour_text(minute).alias("hour"),
        times.minute_text(minute).alias("minute"),
        "ad_id",
        "click_count",
    )


def last_hour(trend: DataFrame, now: Column) -> DataFrame:
    """The rows of ``minute_click_counts`` for the 60 minutes that end with the minute of ``now``."""
    last = F.date_trunc("minute", now)
    first = last - F.expr("interval 59 minutes")
    minute = F.to_timestamp(
        F.concat(F.col("date").cast("string"), F.lit(" "), "hour", F.lit(":"), "minute"), "yyyy-MM-dd HH:mm"
    )
    return trend.where(F.col("date").between(F.to_date(first), F.to_date(last))).where(minute.between(first, last))
