from __future__ import annotations

from clickloom.operators import categories as c
from frames import action, actions


def test_counts_of_clicks_orders_and_payments(spark, rows):
    log = actions(
        spark,
        action("a", click_category_id=1),
        action("a", click_category_id=1, order_category_ids=[1, 2], pay_category_ids=[2]),
        action("b", order_category_ids=[2], pay_category_ids=[3, 2]),
        action("b", search_keyword="none of them"),
    )
    pairs = c.session_categories(log)
    assert rows(pairs) == [
        ("a", 1, 2, 1, 0),
        ("a", 2, 0, 1, 1),
        ("b", 2, 0, 1, 1),
        ("b", 3, 0, 0, 1),
    ]
    assert rows(c.category_counts(pairs)) == [(1, 2, 1, 0), (2, 0, 2, 2), (3, 0, 0, 1)]
    assert rows(c.category_session_clicks(pairs)) == [(1, "a", 2)]


def test_an_id_listed_twice_counts_twice(spark, rows):
    pairs = c.session_categories(actions(spark, action("a", order_category_ids=[4, 4])))
    assert rows(pairs) == [("a", 4, 0, 2, 0)]


def test_top_categories_sort_by_three_counts_then_id(spark, plan):
    counts = spark.createDataFrame(
        [(i, 1, 0, 0) for i in range(20, 30)] + [(1, 5, 0, 0), (2, 5, 1, 0), (3, 5, 1, 2), (4, 9, 0, 0)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    )
    top = c.top_categories(counts)
    assert [r.category_id for r in top.collect()] == [4, 3, 2, 1, 20, 21, 22, 23, 24, 25]
    assert "TakeOrderedAndProject" in plan(top)


def test_top_sessions_per_category(spark, rows, plan):
    pairs = spark.createDataFrame(
        [(f"s{i:02}", 1, i // 2, 0, 0) for i in range(2, 30)] + [("z", 2, 0, 3, 0), ("y", 2, 1, 0, 0), ("x", 3, 9, 0, 0)],
        "session_id string, category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    )
    hottest = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    top = c.top_sessions(pairs, hottest)
    expected = sorted(((1, f"s{i:02}", i // 2) for i in range(2, 30)), key=lambda r: (-r[2], r[1]))[:10]
    assert rows(top) == sorted([*expected, (2, "y", 1)], key=str)
    text = plan(top)
    assert "row_number(), 10, Partial" in text
