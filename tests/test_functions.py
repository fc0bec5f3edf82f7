from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from clickloom.functions import times, values


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_times(spark):
    at = F.lit("2024-03-01 07:05:09")
    time = times.parse_time(at)
    assert _one(
        spark,
        time,
        times.format_time(time),
        times.format_date(time),
        times.date_key(time),
        times.minute_key(time),
        times.parse_date_key(F.lit("20240301")),
        times.hour_text(time),
        times.minute_text(time),
    ) == (
        datetime(2024, 3, 1, 7, 5, 9),
        "2024-03-01 07:05:09",
        "2024-03-01",
        "20240301",
        "202403010705",
        date(2024, 3, 1),
        "07",
        "05",
    )


def test_epoch_and_difference(spark):
    start, end = times.from_epoch_millis(F.lit(1709276709999)), F.lit("2024-03-01 07:06:10").cast("timestamp")
    assert _one(spark, times.format_time(start), times.seconds_between(start, end)) == ("2024-03-01 07:05:09", 61)


def test_ids(spark):
    nothing = F.lit(None).cast("string")
    assert _one(
        spark,
        values.id_list(F.lit("1,11")),
        values.id_list(F.lit("")),
        values.id_list(nothing),
        values.clicked_id(F.lit(-999).cast("bigint")),
        values.clicked_id(F.lit(0).cast("bigint")),
    ) == ([1, 11], None, None, None, 0)


def test_ratio_rounds_half_up_and_survives_zero(spark):
    def share(part, total):
        return values.ratio(F.lit(part).cast("bigint"), F.lit(total).cast("bigint"))

    assert _one(spark, share(29, 200), share(1, 8), share(1, 3), share(0, 0)) == (0.15, 0.13, 0.33, None)


def test_as_text(spark):
    df = spark.sql("select date'2024-03-01' as d, timestamp'2024-03-01 07:05:09' as t, array(3, 1) as l, 5 as n")
    assert tuple(values.as_text(df).first()) == ("2024-03-01", "2024-03-01 07:05:09", "3,1", 5)


def test_id_lists_leave_out_what_does_not_read(spark):
    texts = [("1,2,",), ("1, 2",), (",,",), ("",), (None,), ("x,3,99999999999999999999",)]
    got = spark.createDataFrame(texts, "t string").select(values.id_list(F.col("t")).alias("ids")).collect()
    assert [r.ids for r in got] == [[1, 2], [1, 2], [], None, None, [3]]


def test_a_time_that_does_not_read_is_null(spark):
    got = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",)], "t string").select(times.parse_time(F.col("t")).alias("t"))
    assert [r.t is None for r in got.collect()] == [False, True]
