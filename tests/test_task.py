from __future__ import annotations

import json

import pytest

from clickloom.plans.session_task import SessionTables, run_session_task
from clickloom.schemas import schema_of
from clickloom.sinks.tables import JdbcTables, ParquetTables
from clickloom.sources.tables import read_jdbc_table, read_table
from frames import Recorder, action, actions, users

TABLES = ("session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_session")


@pytest.fixture(scope="module")
def inputs(spark):
    log = actions(
        spark,
        action("s1", 0, user_id=1, search_keyword="tea", click_category_id=1),
        action("s1", 5, user_id=1, click_category_id=2),
        action("s1", 9, user_id=1, click_category_id=1),
        action("s2", 0, user_id=2, click_category_id=1, order_category_ids=[3], pay_category_ids=[3]),
        action("s3", 0, user_id=3),
    )
    people = users(spark, (1, 20, "p", "c", "male"), (2, 30, "p", "c", "female"), (3, 90, "p", "c", "male"))
    days = {"startDate": ["2024-03-01"], "endDate": ["2024-03-01"]}
    params = {1: days | {"endAge": ["50"], "startAge": ["0"]}, 2: days | {"sex": ["nobody"]}}
    tasks = spark.createDataFrame(
        [(i, "t", None, None, None, None, None, json.dumps(p)) for i, p in params.items()], schema_of("task")
    )
    return SessionTables(log, people, tasks)


def _run(spark, inputs, results, task_id, **options):
    run_session_task(spark, task_id, inputs, results, **options)
    return {t: results.read(spark, t).where(f"task_id = {task_id}").collect() for t in TABLES}


def test_the_five_tables(spark, inputs, tmp_path):
    got = _run(spark, inputs, ParquetTables(str(tmp_path)), 1)
    stat = got["session_aggr_stat"][0]
    assert (stat.session_count, stat.visit_length_7s_9s_ratio, stat.step_length_1_3_ratio) == (2, 0.5, 1.0)
    assert sorted(map(tuple, got["top10_category"])) == [(1, 1, 3, 0, 0), (1, 2, 1, 0, 0), (1, 3, 0, 1, 1)]
    assert sorted(map(tuple, got["top10_session"])) == [(1, 1, "s1", 2), (1, 1, "s2", 1), (1, 2, "s1", 1)]
    extract = {r.session_id: r for r in got["session_random_extract"]}
    assert set(extract) == {"s1", "s2"}
    assert (extract["s1"].search_keywords, extract["s1"].click_category_ids) == (["tea"], [1, 2])
    detail = got["session_detail"]
    # s1 is hot in two categories, and still each of its actions is there once per source.
    assert sorted((r.source, r.session_id) for r in detail) == [
        *[("extract", "s1")] * 3,
        ("extract", "s2"),
        *[("top10", "s1")] * 3,
        ("top10", "s2"),
    ]
    ordered = [r for r in detail if r.order_category_ids]
    assert [r.order_category_ids for r in ordered] == [[3], [3]]


def test_a_page_flow_gives_its_conversion(spark, inputs, tmp_path):
    flow = {"startDate": ["2024-03-01"], "endDate": ["2024-03-01"], "endAge": ["50"], "startAge": ["0"], "targetPageFlow": ["1,2,9"]}
    log = actions(
        spark,
        *(action("s1", at, user_id=1, page_id=page) for at, page in enumerate((1, 2, 1, 2, 9))),
        action("s2", 0, user_id=2, page_id=1),
        *(action("s3", at, user_id=3, page_id=page) for at, page in enumerate((1, 2))),
    )
    task = spark.createDataFrame([(5, "t", None, None, None, None, None, json.dumps(flow))], schema_of("task"))
    results = ParquetTables(str(tmp_path))
    run_session_task(spark, 5, SessionTables(log, inputs.users, task), results)
    # the user of s3 is too old
    got = sorted(map(tuple, results.read(spark, "page_conversion").collect()))
    assert got == [(5, 1, 1, 2, 2, 3, 0.6667), (5, 2, 2, 9, 1, 2, 0.5)]


def test_running_again_replaces_and_other_tasks_stay(spark, inputs, tmp_path):
    results = ParquetTables(str(tmp_path))
    first = _run(spark, inputs, results, 1)
    nobody = _run(spark, inputs, results, 2)
    assert nobody["session_aggr_stat"][0].session_count == 0
    assert nobody["session_aggr_stat"][0].step_length_1_3_ratio is None
    assert [len(nobody[t]) for t in TABLES] == [1, 0, 0, 0, 0]
    again = _run(spark, inputs, results, 1)
    assert {t: sorted(map(str, r)) for t, r in first.items()} == {t: sorted(map(str, r)) for t, r in again.items()}
    fewer = _run(spark, inputs, results, 1, extract_total=0)
    assert fewer["session_random_extract"] == []
    assert {r.source for r in fewer["session_detail"]} == {"top10"}


def test_an_unknown_task_raises(spark, inputs, tmp_path):
    with pytest.raises(LookupError):
        run_session_task(spark, 3, inputs, ParquetTables(str(tmp_path)))


def test_groups_are_replaced_whole(spark, rows, tmp_path):
    results = ParquetTables(str(tmp_path))

    def write(*values):
        df = spark.createDataFrame(list(values), "date string, province string, ad_id bigint, click_count bigint")
        results.replace_groups(df, "ad_province_top3", ("date", "province"))

    write(("2024-03-01", "100", 1, 5), ("2024-03-01", "100", 2, 4), ("2024-03-01", "a_b", 1, 1))
    write(("2024-03-01", "100", 3, 9), ("2024-03-02", "100", 1, 1))
    got = [(str(d), *rest) for d, *rest in rows(results.read(spark, "ad_province_top3"))]
    assert got == [("2024-03-01", "100", 3, 9), ("2024-03-01", "a_b", 1, 1), ("2024-03-02", "100", 1, 1)]


def test_database_rows_are_staged_as_text(spark, monkeypatch):
    writer = Recorder()
    said = []
    monkeypatch.setattr(JdbcTables, "_execute", lambda self, session, *statements: said.extend(statements))
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda self: writer))
    df = spark.createDataFrame([(1, 5, 0, 0)], "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    JdbcTables("jdbc:mysql://host/db", {"user": "me"}).write_task_rows(df, "top10_category", 4)
    assert writer.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:mysql://host/db", "dbtable": "top10_category_task_4", "user": "me"}),
        ("mode", ("overwrite",), {}),
        ("save", (), {}),
    ]
    assert [s.split()[0] for s in said] == ["DELETE", "INSERT", "DROP"]


def test_a_database_table_is_published_whole(spark, monkeypatch):
    writer = Recorder()
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda self: writer))
    JdbcTables("jdbc:mysql://host/db").publish(spark.createDataFrame([(5,)], "user_id bigint"), "ad_blacklist")
    assert writer.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:mysql://host/db", "dbtable": "ad_blacklist", "truncate": "true"}),
        ("mode", ("overwrite",), {}),
        ("save", (), {}),
    ]


def test_a_database_table_is_read_with_its_options():
    session = Recorder()
    session.read = session
    read_jdbc_table(session, "jdbc:mysql://host/db", "task", user="me")
    assert session.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:mysql://host/db", "dbtable": "task", "user": "me"}),
        ("load", (), {}),
    ]


def test_tables_are_read_by_path_or_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.range(4).createOrReplaceTempView("four_rows")
    assert (read_table(spark, path).count(), read_table(spark, "four_rows").count()) == (3, 4)
