from __future__ import annotations

from collections import Counter
from datetime import date, datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from clickloom.operators import ads
from clickloom.operators.upsert import upsert_accumulate, upsert_replace
from clickloom.sources.adlog import DEFECTS, file_lines, kafka_lines, log_quality, parse_ad_log
from frames import Recorder, lines, log_line

NOON = datetime(2024, 3, 1, 12, 0, 30)
DAY = date(2024, 3, 1)


def test_parse(spark):
    good = log_line(NOON, "New_York", "NATION_2", 7, 3)
    row = parse_ad_log(lines(spark, good)).first()
    assert tuple(row) == (NOON, DAY, "New_York", "NATION_2", 7, 3)


def test_kafka_options(spark):
    session = Recorder()
    session.readStream = session
    kafka_lines(session, "a:9092,b:9092", "ads,more-ads", startingOffsets="latest")
    assert [call for call in session.calls if call[0] != "select"] == [
        ("format", ("kafka",), {}),
        ("option", ("kafka.bootstrap.servers", "a:9092,b:9092"), {}),
        ("option", ("subscribe", "ads,more-ads"), {}),
        ("options", (), {"startingOffsets": "latest"}),
        ("load", (), {}),
    ]


def test_bad_lines_are_dropped(spark):
    good = log_line(NOON, "p", "c", 7, 3)
    bad = ["", "x", "1 p c 7", "t p c 7 3", "1 p c seven 3", "1 p c 7 3x", "1,p,c,7,3", "99999999999999999999 p c 7 3"]
    assert parse_ad_log(lines(spark, good, good + " more", None, *bad)).count() == 2


def test_numbers_are_read_up_to_their_limits(spark, rows):
    largest, millis = 2**63 - 1, 253402300799999
    kept = [f"{millis} p c {largest} {-largest}", f"0 p c 0 {10**18}", f"-1 p c +5 {largest - 10}"]
    dropped = [f"{millis + 1} p c 1 1", f"{10**17} p c 1 1", f"1 p c {largest + 1} 1", f"1 p c 1 {10**19}"]
    got = parse_ad_log(lines(spark, *kept, *dropped))
    assert rows(got, "user_id", "ad_id") == [(0, 10**18), (5, largest - 10), (largest, -largest)]
    assert rows(got.select(F.col("date").cast("string"))) == [("1969-12-31",), ("1970-01-01",), ("9999-12-31",)]


def test_dropped_lines_are_counted(spark, tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    (path / "a.txt").write_text("\n".join([log_line(NOON, "p", "c", 1, 1), "bad", "1 2"]) + "\n")
    clicks = parse_ad_log(file_lines(spark, str(path)), metrics="ad_log")
    query = (
        clicks.writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    observed = query.lastProgress["observedMetrics"]["ad_log"]
    assert (observed["lines"], observed["dropped"]) == (3, 2)


def test_lines_are_dropped_for_a_reason(spark):
    good = log_line(NOON, "p", "c", 7, 3)
    bad = {"": "empty", "x": "short", "1 p c 7": "short", "t p c 7 3": "time", "99999999999999999999 p c 7 3": "time", "1 p c seven 3": "user", "1 p c 7 3x": "ad", "1 p c 7 ": "ad", "t p c u a": "time"}
    observation = Observation()
    assert parse_ad_log(lines(spark, good, good + " more", None, *bad), metrics=observation).count() == 2
    got = dict(map(tuple, log_quality(spark, observation).collect()))
    want = Counter([*bad.values(), "empty"])
    assert got == {"all": len(bad) + 3, **{d: want[d] for d in DEFECTS}}


def _clicks(spark, *rows):
    """Rows of (hour, province, city, user, ad)."""
    return parse_ad_log(lines(spark, *(log_line(datetime(2024, 3, 1, h), *rest) for h, *rest in rows)))


def test_counts_are_the_same_from_clicks_and_from_cells(spark, rows):
    clicks = _clicks(spark, *((h, f"p{h % 2}", f"p{h % 2}_c{h % 3}", h % 4, h % 5) for h in range(24)))
    cells = ads.click_cells(clicks)
    for count in (ads.user_click_counts, ads.city_click_counts, ads.province_click_counts):
        assert rows(count(clicks)) == rows(count(cells))


def test_blacklist_threshold_is_inclusive_and_per_day_and_ad(spark, rows):
    counts = spark.createDataFrame(
        [(DAY, 1, 1, 99), (DAY, 1, 2, 99), (DAY, 2, 1, 100), (DAY, 2, 2, 500), (DAY, 3, 1, 101)],
        "date date, user_id bigint, ad_id bigint, click_count bigint",
    )
    assert rows(ads.over_clicking_users(counts)) == [(2,), (3,)]


def test_blacklisted_users_clicks_are_dropped(spark, rows):
    clicks = _clicks(spark, (1, "p", "c", 1, 1), (2, "p", "c", 2, 1), (3, "p", "c", 1, 2))
    banned = spark.createDataFrame([(1,), (9,)], "user_id bigint")
    assert rows(ads.without_users(clicks, banned), "user_id") == [(2,)]


def test_top_ads_per_day_and_province(spark, rows, plan):
    other = date(2024, 3, 2)
    counts = spark.createDataFrame(
        [(DAY, "a_b", ad, 10) for ad in (5, 4, 3, 2)] + [(DAY, "a_b", 1, 1), (other, "a_b", 1, 1), (DAY, "z", 9, 2)],
        "date date, province string, ad_id bigint, click_count bigint",
    )
    top = ads.province_top_ads(counts)
    assert rows(top) == sorted(
        [(DAY, "a_b", ad, 10) for ad in (2, 3, 4)] + [(other, "a_b", 1, 1), (DAY, "z", 9, 2)], key=str
    )
    assert "row_number(), 3, Partial" in plan(top)


def test_trend_is_per_minute_and_ad(spark, rows):
    times = [datetime(2024, 3, 1, 9, 5, s) for s in (0, 59)] + [datetime(2024, 3, 1, 9, 6)]
    clicks = parse_ad_log(lines(spark, *(log_line(t, "p", "c", 1, 4) for t in times), log_line(times[0], "p", "c", 1, 5)))
    assert rows(ads.minute_click_counts(clicks)) == [
        (DAY, "09", "05", 4, 2),
        (DAY, "09", "05", 5, 1),
        (DAY, "09", "06", 4, 1),
    ]


def test_last_hour_spans_midnight(spark, rows):
    trend = spark.createDataFrame(
        [(date(2024, 2, 29), "23", "10", 1, 1), (date(2024, 2, 29), "23", "11", 1, 2), (DAY, "00", "10", 1, 3)]
        + [(DAY, "00", "11", 1, 4)],
        "date date, hour string, minute string, ad_id bigint, click_count bigint",
    )
    now = F.lit("2024-03-01 00:10:40").cast("timestamp")
    assert rows(ads.last_hour(trend, now), "click_count") == [(2,), (3,)]


KEYS = ("k",)


def test_upsert_replace(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, click_count bigint")
    new = spark.createDataFrame([("b", 5), ("c", 6)], "k string, click_count bigint")
    assert rows(upsert_replace(old, new, KEYS)) == [("a", 1), ("b", 5), ("c", 6)]


def test_upsert_accumulate(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, click_count bigint")
    new = spark.createDataFrame([("b", 5), ("c", 6)], "k string, click_count bigint")
    assert rows(upsert_accumulate(old, new, KEYS)) == [("a", 1), ("b", 7), ("c", 6)]
