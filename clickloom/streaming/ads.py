"""The streaming jobs on the ad-click log."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickloom.operators import ads, sliding
from clickloom.sinks.tables import ParquetTables
from clickloom.streaming.state import FOLD_EVERY, BannedUsers, DailyCounts, last_batch, mark_finished

BATCH_INTERVAL = "5 seconds"
ROWS_PER_FILE = 500_000


@contextmanager
def _shuffle_partitions(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Another partition count for the time of a stream's start; a stream copies the session's settings there."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if partitions is not None:
        spark.conf.set(name, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _started(
    spark: SparkSession, writer: DataStreamWriter, root: str, available_now: bool, partitions: int | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", f"{root}/checkpoint")
    trigger = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
    with _shuffle_partitions(spark, partitions):
        return writer.trigger(**trigger).start()


class ClickStream:
    """Daily click tables behind a blacklist that feeds back into the stream.

    Clicks of users banned by earlier batches are dropped; the rest are added to the per-user and
    per-city counts; users who thereby reach ``threshold`` clicks on an ad in a day are banned from the
    next batch on.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        threshold: int = ads.BLACKLIST_THRESHOLD,
        fold_every: int = FOLD_EVERY,
    ) -> None:
        self.spark, self.root, self.threshold = spark, root, threshold
        self.banned = BannedUsers(spark, root, fold_every)
        self.user_counts = DailyCounts(spark, root, "ad_user_click_count", fold_every=fold_every)
        self.city_counts = DailyCounts(spark, root, "ad_stat", fold_every=fold_every)
        self.top_ads = ParquetTables(f"{root}/ranked")

    def process(self, clicks: DataFrame, batch_id: int) -> None:
        """One micro-batch. Running it again with the same clicks changes nothing."""
        for table in (self.banned, self.user_counts, self.city_counts):
            table.fold(batch_id)

        banned = self.banned.before(batch_id)
        cells = ads.without_users(ads.click_cells(clicks), banned).persist()
        try:
            self.user_counts.write(ads.user_click_counts(cells), batch_id)
            self.city_counts.write(ads.city_click_counts(cells), batch_id)
        finally:
            cells.unpersist()
        totals = self.user_counts.totals(batch_id, touched=self.user_counts.keys)
        self.banned.write(ads.over_clicking_users(totals, self.threshold), batch_id)
        self._rank(batch_id)
        mark_finished(self.spark, self.root, batch_id)

    def _rank(self, batch_id: int) -> None:
        """Rank the ads of the days and provinces that the batch has added to, and put those groups in the place of the stored ones."""
        groups = ("date", "province")
        counts = self.city_counts.totals(batch_id, touched=groups)
        top = ads.province_top_ads(ads.province_click_counts(counts))
        self.top_ads.replace_groups(top, "ad_province_top3", groups)

    def start(self, clicks: DataFrame, available_now: bool = False, partitions: int | None = None) -> StreamingQuery:
        """``partitions``: shuffle partitions of the stream's own batches, if not the session's."""
        writer = clicks.writeStream.foreachBatch(self.process)
        return _started(self.spark, writer, self.root, available_now, partitions)

    def tables(self, dates: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """The tables as the last finished batch left them, for all days or the given ones.

        The top ads are the stored ones: a batch that is running may already have replaced those of its days and provinces.
        """
        last = last_batch(self.spark, self.root)
        top = self.top_ads.read(self.spark, "ad_province_top3")
        if dates is not None:
            dates = list(dates)
            top = top.where(F.col("date").isin([date.fromisoformat(d) for d in dates]))
        return {
            "ad_blacklist": self.banned.after(last),
            "ad_user_click_count": self.user_counts.totals(last, dates),
            "ad_stat": self.city_counts.totals(last, dates),
            "ad_province_top3": top,
        }


class CountStream:
    """A running count kept in Spark's streaming state, its changed rows stored batch by batch.

    A later batch's count of a key replaces the earlier one. Counts only grow, so the largest is the latest.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, fold_every: int = FOLD_EVERY) -> None:
        self.spark, self.root = spark, root
        self.counts = DailyCounts(spark, root, table, combine=F.max, fold_every=fold_every)

    def process(self, changed: DataFrame, batch_id: int) -> None:
        self.counts.fold(batch_id)
        # The state has a fixed number of partitions, and each would leave a file of few rows; a micro-batch runs without
        # adaptive execution, so the number of files is set from the number of rows.
        changed = changed.persist()
        try:
            files = -(-changed.count() // ROWS_PER_FILE)
            self.counts.write(changed.coalesce(max(1, files)), batch_id)
        finally:
            changed.unpersist()
        mark_finished(self.spark, self.root, batch_id)

    def start(self, counts: DataFrame, available_now: bool = False, partitions: int | None = None) -> StreamingQuery:
        """``partitions``: parts of the state, fixed when the stream first starts, if not the session's number."""
        writer = counts.writeStream.outputMode("update").foreachBatch(self.process)
        return _started(self.spark, writer, self.root, available_now, partitions)

    def table(self, dates: Iterable[str] | None = None) -> DataFrame:
        """The counts as the last finished batch left them, for all days or the given ones."""
        return self.counts.totals(last_batch(self.spark, self.root), dates)


def start_trend(
    spark: SparkSession,
    clicks: DataFrame,
    root: str,
    watermark: str | None = None,
    available_now: bool = False,
    partitions: int | None = None,
) -> tuple[CountStream, StreamingQuery]:
    """Clicks per minute and ad, over all users.

    Without a watermark no click is ever too late and the state keeps every minute. With one, say
    ``"2 hours"``, minutes older than that leave the state and their late clicks are dropped.
    """
    if watermark is not None:
        clicks = clicks.withWatermark("click_time", watermark)
    stream = CountStream(spark, root, "ad_click_trend")
    return stream, stream.start(ads.minute_click_counts(clicks), available_now, partitions)


def start_running_stat(
    spark: SparkSession,
    clicks: DataFrame,
    root: str,
    watermark: str | None = None,
    available_now: bool = False,
    partitions: int | None = None,
) -> tuple[CountStream, StreamingQuery]:
    """Clicks per day, province, city and ad, for a log without a blacklist.

    With a watermark, say ``"2 days"``, days that ended longer ago leave the state and their late clicks are dropped.
    """
    if watermark is not None:
        # the day as a window: Spark then knows when its state has had its time
        day = F.window("click_time", "1 day")
        counts = clicks.withWatermark("click_time", watermark).groupBy(day, "date", "province", "city", "ad_id").count()
        counts = counts.select("date", "province", "city", "ad_id", F.col("count").alias("click_count"))
        stream = CountStream(spark, root, "ad_stat")
        return stream, stream.start(counts, available_now, partitions)
    stream = CountStream(spark, root, "ad_stat")
    return stream, stream.start(ads.city_click_counts(clicks), available_now, partitions)


def start_sliding(
    spark: SparkSession,
    clicks: DataFrame,
    root: str,
    watermark: str | None = None,
    available_now: bool = False,
    partitions: int | None = None,
) -> tuple[CountStream, StreamingQuery]:
    """Clicks per ad in the last hour, every ten seconds.

    The stream keeps the counts of panes of one slide; ``sliding.sliding_click_counts(stream.table())`` adds them up to windows, and
    ``sliding.sliding_at`` does for one moment. With a watermark, panes older than that leave the state and their late clicks are dropped.
    """
    if watermark is not None:
        clicks = clicks.withWatermark("click_time", watermark)
    stream = CountStream(spark, root, "ad_click_pane")
    return stream, stream.start(sliding.pane_click_counts(clicks), available_now, partitions)


class ArrivalStream:
    """How many clicks have arrived for each day, late or not: what a stream with a watermark is accounted against."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = FOLD_EVERY) -> None:
        self.spark, self.root = spark, root
        self.counts = DailyCounts(spark, root, "ad_click_arrivals", fold_every=fold_every)

    def process(self, clicks: DataFrame, batch_id: int) -> None:
        """One micro-batch. Running it again with the same clicks changes nothing."""
        self.counts.fold(batch_id)
        self.counts.write(clicks.groupBy("date").agg(F.count(F.lit(1)).alias("click_count")), batch_id)
        mark_finished(self.spark, self.root, batch_id)

    def start(self, clicks: DataFrame, available_now: bool = False, partitions: int | None = None) -> StreamingQuery:
        """``partitions``: shuffle partitions of the stream's own batches, if not the session's."""
        writer = clicks.writeStream.foreachBatch(self.process)
        return _started(self.spark, writer, self.root, available_now, partitions)

    def table(self) -> DataFrame:
        """The counts as the last finished batch left them."""
        return self.counts.totals(last_batch(self.spark, self.root))


def late_clicks(arrivals: DataFrame, counted: DataFrame) -> DataFrame:
    """(date, arrived, counted, late): what has arrived for each day, what a stream with a watermark has counted of it, and what came too late.

    Both have ``date`` and ``click_count``. Spark itself reports late rows only after they are partly added up, so its number is no count of clicks.
    """
    totals = counted.groupBy("date").agg(F.sum("click_count").alias("counted"))
    seen = arrivals.groupBy("date").agg(F.sum("click_count").alias("arrived"))
    both = seen.join(totals, "date", "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return both.select("date", "arrived", "counted", (F.col("arrived") - F.col("counted")).alias("late"))
