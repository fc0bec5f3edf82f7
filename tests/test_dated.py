from __future__ import annotations

import os
from pathlib import Path

import pytest

from clickloom.session import scratch_path
from clickloom.sinks.dated import DatedTable
from clickloom.sinks.tables import JdbcTables


def _counts(spark, *rows):
    frame = spark.createDataFrame(rows, "d string, ad_id bigint, click_count bigint")
    return frame.selectExpr("cast(d as date) as date", "'p' as province", "'c' as city", "ad_id", "click_count")


def _files(path):
    return {str(f): (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path).rglob("*.parquet")}


@pytest.fixture
def table(spark):
    return DatedTable(spark, scratch_path(spark, "dated"), "ad_stat")


def _rows(table):
    return sorted((str(r.date), r.ad_id, r.click_count) for r in table.read().collect())


def test_only_given_dates_are_rewritten(spark, table):
    assert table.read().count() == 0
    table.accumulate(_counts(spark, ("2024-01-01", 1, 5), ("2024-01-02", 1, 7)), 0)
    before = _files(f"{table.path}/date=2024-01-01")
    table.accumulate(_counts(spark, ("2024-01-02", 1, 1), ("2024-01-02", 2, 1), ("2024-01-03", 9, 9)), 1)
    table.replace(_counts(spark, ("2024-01-03", 9, 2)), 2)
    assert _rows(table) == [("2024-01-01", 1, 5), ("2024-01-02", 1, 8), ("2024-01-02", 2, 1), ("2024-01-03", 9, 2)]
    assert before and _files(f"{table.path}/date=2024-01-01") == before
    assert os.listdir(f"{table.path}_batches") == ["2"]


def test_a_batch_may_run_again(spark, table, monkeypatch):
    table.accumulate(_counts(spark, ("2024-01-01", 1, 5)), 0)
    more = _counts(spark, ("2024-01-01", 1, 2), ("2024-01-02", 3, 4))
    # lost after the merged dates were written, before they were in place
    monkeypatch.setattr(DatedTable, "_put_in_place", lambda self, batch: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        table.accumulate(more, 1)
    monkeypatch.undo()
    for _ in range(3):
        table.accumulate(more, 1)
        assert _rows(table) == [("2024-01-01", 1, 7), ("2024-01-02", 3, 4)]
    table.accumulate(more.limit(0), 2)
    assert _rows(table) == [("2024-01-01", 1, 7), ("2024-01-02", 3, 4)]


def test_a_task_in_a_database_may_run_again(spark):
    """No database here: tables are kept by a recorder that does what the statements say."""
    held: dict[str, list] = {"top10_category": [(7, 1, 1, 1, 1)]}

    class Recorder(JdbcTables):
        def _write(self, rows, table, mode, **options):
            assert mode == "overwrite"
            held[table] = [tuple(r) for r in rows.collect()]

        def _execute(self, session, *statements):
            delete, insert, drop = statements
            assert delete == "DELETE FROM top10_category WHERE task_id = 3"
            assert insert.startswith("INSERT INTO top10_category (task_id, category_id") and insert.endswith("FROM top10_category_task_3")
            held["top10_category"] = [r for r in held["top10_category"] if r[0] != 3] + held["top10_category_task_3"]
            assert drop == "DROP TABLE top10_category_task_3"
            del held["top10_category_task_3"]

    rows = spark.createDataFrame([(5, 6, 7, 8)], "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    for _ in range(2):
        Recorder("jdbc:none").write_task_rows(rows, "top10_category", 3)
    assert held == {"top10_category": [(7, 1, 1, 1, 1), (3, 5, 6, 7, 8)]}
