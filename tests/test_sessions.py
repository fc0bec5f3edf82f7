from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import sessions
from clickloom.params import TaskParams
from clickloom.sources.tables import scan_actions, typed_actions
from frames import DAY, action, actions, users

ANY = TaskParams(DAY, DAY)


def test_rollup(spark):
    log = actions(
        spark,
        action("s", 30, user_id=8, search_keyword="b"),
        action("s", 5, user_id=7, click_category_id=11),
        action("s", 66, user_id=7, search_keyword="a", click_category_id=1),
        action("s", 66, user_id=7, search_keyword="b", click_category_id=11),
        action("t", 0, user_id=9),
    )
    got = {r.session_id: r for r in sessions.session_rollup(log).collect()}
    s, t = got["s"], got["t"]
    assert s.user_id == 7  # of the earliest action
    assert (s.start_time, s.end_time) == (datetime(2024, 3, 1, 10, 0, 5), datetime(2024, 3, 1, 10, 1, 6))
    assert (s.visit_length, s.step_length) == (61, 4)
    assert (s.search_keywords, s.click_category_ids) == (["a", "b"], [1, 11])
    assert (t.visit_length, t.step_length, t.search_keywords, t.click_category_ids) == (0, 1, [], [])


def test_facts_agree_with_rollup(spark, rows):
    log = actions(spark, *(action(f"s{i % 3}", i * 7, user_id=i % 3) for i in range(20)))
    columns = ("session_id", "user_id", "start_time", "end_time", "visit_length", "step_length")
    assert rows(sessions.session_facts(log), *columns) == rows(sessions.session_rollup(log), *columns)


def test_a_session_of_an_unknown_user_is_dropped(spark):
    log = actions(spark, action("known", user_id=1), action("unknown", user_id=2))
    known = users(spark, (1, 20, "p", "c", "male"))
    assert [r.session_id for r in sessions.wanted_sessions(log, known, ANY).collect()] == ["known"]


@pytest.fixture(scope="module")
def people(spark):
    return users(
        spark,
        (1, 10, "doctor", "Rome", "male"),
        (2, 50, "baker", "Oslo", "female"),
        (3, 51, "baker", "Rome", "female"),
        (4, None, None, None, None),
    )


@pytest.fixture(scope="module")
def visits(spark):
    return actions(
        spark,
        action("s1", user_id=1, search_keyword="tea", click_category_id=1),
        action("s1", user_id=1, search_keyword="cake"),
        action("s2", user_id=2, click_category_id=11),
        action("s3", user_id=3, search_keyword="tea time"),
        action("s4", user_id=4),
    )


@pytest.mark.parametrize(
    ("given", "kept"),
    [
        ({}, "s1 s2 s3 s4"),
        ({"start_age": 10, "end_age": 50}, "s1 s2"),
        ({"start_age": 11, "end_age": 51}, "s2 s3"),
        ({"start_age": 11}, "s1 s2 s3 s4"),
        ({"end_age": 11}, "s1 s2 s3 s4"),
        ({"professionals": ("baker", "smith")}, "s2 s3"),
        ({"cities": ("Rome",)}, "s1 s3"),
        ({"sex": "female"}, "s2 s3"),
        ({"keywords": ("tea",)}, "s1"),
        ({"keywords": ("cake", "bread")}, "s1"),
        ({"category_ids": (1,)}, "s1"),
        ({"category_ids": (11, 5)}, "s2"),
        ({"category_ids": ()}, ""),
        ({"sex": "female", "cities": ("Rome",), "start_age": 0, "end_age": 60}, "s3"),
        ({"sex": "male", "cities": ("Oslo",)}, ""),
    ],
)
def test_filter(visits, people, given, kept):
    found = sessions.wanted_sessions(visits, people, replace(ANY, **given))
    assert sorted(r.session_id for r in found.collect()) == kept.split()


def test_detail_has_each_action_once(spark, visits):
    wanted = spark.createDataFrame([("s1",)], "session_id string")
    detail = sessions.actions_of(visits, wanted)
    assert detail.columns == list(sessions.DETAIL_COLUMNS) and "city_id" not in detail.columns
    assert detail.count() == 2


TEXT_LOG = """date string, user_id bigint, session_id string, page_id bigint, action_time string,
    search_keyword string, click_category_id bigint, click_product_id bigint, order_category_ids string,
    order_product_ids string, pay_category_ids string, pay_product_ids string, city_id bigint"""


def test_text_log_is_typed(spark):
    log = spark.createDataFrame(
        [("2024-03-01", 1, "s", 2, "2024-03-01 09:08:07", None, -999, -999, "3,33", "4", None, "", 5)], TEXT_LOG
    )
    row = typed_actions(log).first()
    assert (row.date, row.action_time) == (date(2024, 3, 1), datetime(2024, 3, 1, 9, 8, 7))
    assert (row.click_category_id, row.click_product_id) == (None, None)
    assert (row.order_category_ids, row.order_product_ids) == ([3, 33], [4])
    assert (row.pay_category_ids, row.pay_product_ids) == (None, None)


@pytest.mark.parametrize("stored_as", ["date", "string"])
def test_date_range_includes_both_ends(spark, stored_as):
    days = [date(2024, 2, 29), date(2024, 3, 1), date(2024, 3, 2), date(2024, 3, 3)]
    log = actions(spark, *(action(str(d), day=d) for d in days)).withColumn("date", F.col("date").cast(stored_as))
    kept = scan_actions(log, TaskParams(days[1], days[2]))
    assert kept.schema["date"].dataType.typeName() == "date"
    assert sorted(r.date for r in kept.collect()) == days[1:3]


def test_scan_of_a_log_laid_out_by_date_reads_only_its_days(spark, plan, tmp_path):
    days = [date(2024, 3, d) for d in range(1, 8)]
    path = str(tmp_path / "log")
    actions(spark, *(action(str(d), day=d) for d in days)).write.partitionBy("date").parquet(path)
    scanned = scan_actions(spark.read.parquet(path), TaskParams(days[2], days[3])).select("session_id", "date")
    text = plan(scanned)
    assert "PartitionFilters: [isnotnull(date" in text
    assert scanned.count() == 2 and "order_category_ids" not in text
