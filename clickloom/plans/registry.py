"""The named queries, each over the whole of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.values import as_text
from clickloom.functions import times
from clickloom.operators import ads, categories, pages, sampling, sessions, sliding, stats, upsert
from clickloom.params import TaskParams
from clickloom.plans.daily_ads import DailyAds, daily_ads
from clickloom.plans.session_task import SessionTables, extracted_sessions, run_session_task
from clickloom.schemas import schema_of
from clickloom.session import scratch_path, stored
from clickloom.sinks.dated import DatedTable
from clickloom.sinks.tables import ParquetTables
from clickloom.sources.adlog import file_lines, log_quality, parse_ad_log
from clickloom.sources.fixtures import AD_THRESHOLD, FIRST_DAY, LAST_DAY, Fixtures
from clickloom.sources.tables import scan_actions
from clickloom.streaming.ads import ArrivalStream, ClickStream, late_clicks, start_running_stat, start_sliding, start_trend

Query = Callable[[SparkSession, str], DataFrame]

ALL_DAYS = TaskParams(date.fromisoformat(FIRST_DAY), date.fromisoformat(LAST_DAY))  # no data can leave this range
SOME_DAYS = TaskParams(date(2024, 1, 5), date(2024, 1, 20))
PICKY = TaskParams(
    ALL_DAYS.start_date,
    ALL_DAYS.end_date,
    start_age=10,
    end_age=50,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=tuple(f"NATION_{i}" for i in range(18)),
    sex="male",
    keywords=("kw1", "kw2", "kw5"),
    category_ids=tuple(range(10, 40)),
)
PAGE_FLOW = (1, 2, 3, 4)
EXTRACT_TOTAL, EXTRACT_SEED = 3000, 7
SPLIT_DAY, OVERLAP_DAY = "2024-01-16", "2024-01-11"
STREAM_SLICES = 4
LATE_SLICE_DAYS, WATERMARK = 8, "3 days"
TASK_ID, TASK_PARAM = 1, f'{{"startDate":["{FIRST_DAY}"],"endDate":["{LAST_DAY}"],"startAge":["5"],"endAge":["55"]}}'

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, sf_dir: as_text(build(Fixtures(spark, sf_dir)))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _actions(fx: Fixtures, params: TaskParams = ALL_DAYS) -> DataFrame:
    return scan_actions(fx.action_log(), params)


def _wanted(fx: Fixtures, params: TaskParams = ALL_DAYS) -> DataFrame:
    return sessions.wanted_sessions(_actions(fx, params), fx.users(), params)


def _stored(df: DataFrame, name: str) -> DataFrame:
    return stored(df, scratch_path(df.sparkSession, name))


def _pairs(fx: Fixtures) -> DataFrame:
    return categories.of_sessions(categories.session_categories(_actions(fx)), _wanted(fx))


def _clicks(fx: Fixtures) -> DataFrame:
    return parse_ad_log(fx.ad_lines())


def _daily(fx: Fixtures) -> DailyAds:
    return daily_ads(_clicks(fx), scratch_path(fx.spark, "daily-ads"), AD_THRESHOLD)


# Sessions


@_query
def action_scan(fx: Fixtures) -> DataFrame:
    return _actions(fx, SOME_DAYS)


@_query
def session_rollup(fx: Fixtures) -> DataFrame:
    return sessions.with_user(sessions.session_rollup(_actions(fx)), fx.users())


@_query
def session_filter(fx: Fixtures) -> DataFrame:
    return _wanted(fx, PICKY)


@_query
def session_histogram(fx: Fixtures) -> DataFrame:
    return stats.session_histogram(_wanted(fx))


@_query
def session_aggr_stat(fx: Fixtures) -> DataFrame:
    return stats.session_aggr_stat(_wanted(fx))


@_query
def session_aggr_stat_filtered(fx: Fixtures) -> DataFrame:
    return stats.session_aggr_stat(_wanted(fx, PICKY))


@_query
def session_detail_filtered(fx: Fixtures) -> DataFrame:
    return sessions.actions_of(_actions(fx), _stored(_wanted(fx, PICKY), "wanted"))


@_query
def page_conversion(fx: Fixtures) -> DataFrame:
    return pages.page_conversion(_actions(fx), PAGE_FLOW)


@_query
def action_scan_text(fx: Fixtures) -> DataFrame:
    """The log with text dates and times and comma lists, some of which do not read."""
    return scan_actions(fx.text_action_log(), SOME_DAYS)


# Categories


@_query
def category_counts(fx: Fixtures) -> DataFrame:
    return categories.category_counts(_pairs(fx))


@_query
def category_session_clicks(fx: Fixtures) -> DataFrame:
    return categories.category_session_clicks(_pairs(fx))


@_query
def top10_category(fx: Fixtures) -> DataFrame:
    return categories.top_categories(categories.category_counts(_pairs(fx)))


def _top_sessions(fx: Fixtures) -> DataFrame:
    pairs = _stored(_pairs(fx), "pairs")
    return categories.top_sessions(pairs, categories.top_categories(categories.category_counts(pairs)))


@_query
def top10_session(fx: Fixtures) -> DataFrame:
    return _top_sessions(fx)


@_query
def top10_session_detail(fx: Fixtures) -> DataFrame:
    return sessions.actions_of(_actions(fx), _stored(_top_sessions(fx), "busiest"))


# Extraction


@_query
def session_hour_counts(fx: Fixtures) -> DataFrame:
    return sampling.hour_counts(_wanted(fx))


@_query
def session_quota(fx: Fixtures) -> DataFrame:
    return sampling.hour_quotas(sampling.hour_counts(_wanted(fx)), EXTRACT_TOTAL)


def _extracted(fx: Fixtures) -> DataFrame:
    wanted = _stored(_wanted(fx), "wanted")
    return extracted_sessions(wanted, EXTRACT_TOTAL, EXTRACT_SEED, scratch_path(fx.spark, "extract"))


@_query
def session_random_extract(fx: Fixtures) -> DataFrame:
    extracted = _extracted(fx)
    return sampling.extract_report(extracted, sessions.actions_of(_actions(fx), extracted))


@_query
def extract_detail(fx: Fixtures) -> DataFrame:
    return sessions.actions_of(_actions(fx), _extracted(fx))


# The whole task


def _shown(column: str) -> Column:
    """A value as text, the same for any engine: ratios in hundredths, nothing as an empty text."""
    value = F.round(F.col(column) * 100).cast("bigint") if column.endswith("_ratio") else F.col(column)
    return F.coalesce(value.cast("string"), F.lit(""))


@_query
def session_task(fx: Fixtures) -> DataFrame:
    """Run the job and return its five tables as rows of (table, content, rows)."""
    spark = fx.spark
    task = (TASK_ID, "all", None, None, None, "session", None, TASK_PARAM)
    tasks = spark.createDataFrame([task], schema_of("task"))
    results = ParquetTables(scratch_path(spark, "session-results"))
    run_session_task(
        spark, TASK_ID, SessionTables(fx.action_log(), fx.users(), tasks), results, EXTRACT_TOTAL, EXTRACT_SEED
    )
    shown = {
        "session_aggr_stat": tuple(c for c in schema_of("session_aggr_stat").names if c != "task_id"),
        "top10_category": ("category_id", "click_count", "order_count", "pay_count"),
        "top10_session": ("category_id", "session_id", "click_count"),
        "session_random_extract": ("session_id", "start_time", "search_keywords", "click_category_ids"),
        "session_detail": ("source", *sessions.DETAIL_COLUMNS),
    }
    parts = [
        as_text(results.read(spark, table).where(F.col("task_id") == TASK_ID))
        .select(F.lit(table).alias("table_name"), F.concat_ws("|", *map(_shown, columns)).alias("content"))
        .groupBy("table_name", "content")
        .agg(F.count(F.lit(1)).alias("rows"))
        for table, columns in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Ads


@_query
def ad_log_parse(fx: Fixtures) -> DataFrame:
    return _clicks(fx)


@_query
def ad_user_click_count(fx: Fixtures) -> DataFrame:
    return ads.user_click_counts(_clicks(fx))


@_query
def ad_blacklist(fx: Fixtures) -> DataFrame:
    return _daily(fx).blacklist


@_query
def ad_filtered_clicks(fx: Fixtures) -> DataFrame:
    return ads.without_users(_clicks(fx), _daily(fx).blacklist)


@_query
def ad_stat(fx: Fixtures) -> DataFrame:
    return _daily(fx).city_counts


@_query
def ad_province_click_count(fx: Fixtures) -> DataFrame:
    return ads.province_click_counts(_daily(fx).city_counts)


@_query
def ad_province_top3(fx: Fixtures) -> DataFrame:
    return _daily(fx).province_top


@_query
def ad_click_trend(fx: Fixtures) -> DataFrame:
    return ads.minute_click_counts(_clicks(fx))


@_query
def ad_trend_last_hour(fx: Fixtures) -> DataFrame:
    clicks = _clicks(fx)
    now = clicks.agg(F.max("click_time")).scalar()
    return ads.last_hour(ads.minute_click_counts(clicks), now)


@_query
def ad_click_sliding(fx: Fixtures) -> DataFrame:
    """Clicks of each ad in the last hour, at every tenth second where they change."""
    return _sliding_text(sliding.sliding_click_counts(sliding.pane_click_counts(_clicks(fx))))


def _sliding_text(counts: DataFrame) -> DataFrame:
    return counts.withColumn("window_end", times.format_time(F.col("window_end")))


@_query
def ad_log_quality(fx: Fixtures) -> DataFrame:
    """How many lines of a log with defects there are and why lines are dropped, observed while the log is parsed and stored."""
    observation = Observation("ad_log_quality")
    _stored(parse_ad_log(fx.defective_ad_lines(), metrics=observation), "clicks")
    return log_quality(fx.spark, observation)


@_query
def ad_time_keys(fx: Fixtures) -> DataFrame:
    """Clicks by date and minute key, with the days that the keys read back to."""
    keys = _clicks(fx).select(times.date_key(F.col("click_time")).alias("date_key"), times.minute_key(F.col("click_time")).alias("minute_key"), "date")
    counts = keys.groupBy("date_key", "minute_key", "date").agg(F.count(F.lit(1)).alias("click_count"))
    read = times.parse_date_key(F.substring("minute_key", 1, 8))
    return counts.select("date_key", "minute_key", times.format_date(read).alias("date"), (read == F.col("date")).alias("same"), "click_count")


# Upserts: city counts up to one day meet city counts from an earlier day on.

_AD_STAT_KEYS = ("date", "province", "city", "ad_id")


def _old_and_new(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    clicks = _clicks(fx)
    old = ads.city_click_counts(clicks.where(F.col("date") < F.lit(SPLIT_DAY).cast("date")))
    new = ads.city_click_counts(clicks.where(F.col("date") >= F.lit(OVERLAP_DAY).cast("date")))
    return old, new.withColumn("click_count", F.col("click_count") * 10)


@_query
def ad_upsert_replace(fx: Fixtures) -> DataFrame:
    return upsert.upsert_replace(*_old_and_new(fx), _AD_STAT_KEYS)


@_query
def ad_upsert_accumulate(fx: Fixtures) -> DataFrame:
    return upsert.upsert_accumulate(*_old_and_new(fx), _AD_STAT_KEYS)


@_query
def ad_upsert_stored(fx: Fixtures) -> DataFrame:
    """A stored table that takes in counts to add, the same batch again, and counts that replace."""
    table = DatedTable(fx.spark, scratch_path(fx.spark, "dated"), "ad_stat")
    old, new = _old_and_new(fx)
    table.accumulate(old, 0)
    for _ in range(2):
        table.accumulate(new, 1)
    table.replace(old.where(F.col("date") >= F.lit(OVERLAP_DAY).cast("date")), 2)
    return table.read()


# Streams. The log arrives in four slices by hour of the day, one micro-batch each, so that every day's
# counts build up over several batches.


def _in_slices(fx: Fixtures, root: str, run: Callable[[DataFrame], None]) -> None:
    lines = fx.ad_lines().withColumn("slice", F.expr(f"hour(ts) div {24 // STREAM_SLICES}"))
    log = f"{root}/log"
    for i in range(STREAM_SLICES):
        lines.where(F.col("slice") == i).select("line").write.text(f"{log}/part{i}")
        run(parse_ad_log(file_lines(fx.spark, f"{log}/*")))


def _replayed(fx: Fixtures) -> ClickStream:
    stream = ClickStream(fx.spark, scratch_path(fx.spark, "ad-clicks"), AD_THRESHOLD, fold_every=2)

    def run(clicks: DataFrame) -> None:
        stream.start(clicks, available_now=True).awaitTermination()

    _in_slices(fx, stream.root, run)
    return stream


@_query
def ad_stream_tables(fx: Fixtures) -> DataFrame:
    """Replay the log through the blacklist loop; the tables it leaves as rows of (table, key, click_count)."""
    frames = _replayed(fx).tables()
    frames["ad_blacklist"] = frames["ad_blacklist"].withColumn("click_count", F.lit(None).cast("bigint"))
    parts = [
        df.select(
            F.lit(table).alias("table_name"),
            F.concat_ws("|", *(c for c in df.columns if c != "click_count")).alias("row_key"),
            "click_count",
        )
        for table, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def ad_stream_trend(fx: Fixtures) -> DataFrame:
    root = scratch_path(fx.spark, "ad-trend")
    streams = []

    def run(clicks: DataFrame) -> None:
        stream, query = start_trend(fx.spark, clicks, root, available_now=True)
        query.awaitTermination()
        streams.append(stream)

    _in_slices(fx, root, run)
    return streams[-1].table()


@_query
def ad_stream_running_stat(fx: Fixtures) -> DataFrame:
    root = scratch_path(fx.spark, "ad-stat")
    streams = []

    def run(clicks: DataFrame) -> None:
        stream, query = start_running_stat(fx.spark, clicks, root, available_now=True)
        query.awaitTermination()
        streams.append(stream)

    _in_slices(fx, root, run)
    return streams[-1].table()


@_query
def ad_stream_sliding(fx: Fixtures) -> DataFrame:
    root = scratch_path(fx.spark, "ad-sliding")
    streams = []

    def run(clicks: DataFrame) -> None:
        stream, query = start_sliding(fx.spark, clicks, root, available_now=True)
        query.awaitTermination()
        streams.append(stream)

    _in_slices(fx, root, run)
    return _sliding_text(sliding.sliding_click_counts(streams[-1].table()))


@_query
def ad_stream_late(fx: Fixtures) -> DataFrame:
    """The log by spans of days, each span with a part of the clicks of the one before: what a trend with a watermark counts of each day, and what comes too late."""
    root = scratch_path(fx.spark, "ad-late")
    day = F.datediff("ts", F.lit("2024-01-01"))
    # every fifth user's clicks arrive a span late
    late = F.when(F.split("line", " ")[3].cast("bigint") % 5 == 0, 1).otherwise(0)
    lines = fx.ad_lines().withColumn("slice", F.floor(day / LATE_SLICE_DAYS).cast("int") + late)
    lines = _stored(lines, "late-lines")
    found = []
    for (i,) in sorted(lines.select("slice").distinct().collect()):
        lines.where(F.col("slice") == i).select("line").write.text(f"{root}/log/part{i}")
        clicks = parse_ad_log(file_lines(fx.spark, f"{root}/log/*"))
        trend, query = start_trend(fx.spark, clicks, f"{root}/trend", watermark=WATERMARK, available_now=True)
        query.awaitTermination()
        arrivals = ArrivalStream(fx.spark, f"{root}/arrivals")
        arrivals.start(clicks, available_now=True).awaitTermination()
        found = [arrivals.table(), trend.table()]
    return late_clicks(*found)
