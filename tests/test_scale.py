"""Plans that must hold when one key has a large share of the rows."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ads, categories, sessions
from clickloom.params import TaskParams
from clickloom.session import stored
from frames import DAY


@contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


HOT_ROWS, OTHER_ROWS = 60_000, 120_000


@pytest.fixture(scope="module")
def hot_log(spark, tmp_path_factory):
    """A third of all actions in one session, in many files."""
    path = str(tmp_path_factory.mktemp("hot") / "log")
    (
        spark.range(0, HOT_ROWS + OTHER_ROWS, 1, 16)
        .selectExpr(
            f"date'{DAY}' as date",
            "if(id % 3 = 0, 0, id div 12) as user_id",
            "if(id % 3 = 0, 'hot', concat('s', id div 12)) as session_id",
            "id % 7 as page_id",
            "timestamp_seconds(1709251200 + id % 12) as action_time",
            "if(id % 4 = 0, concat('kw', id % 50), null) as search_keyword",
            "if(id % 4 = 1, id % 100, null) as click_category_id",
            "id as click_product_id",
            "if(id % 4 = 2, array(id % 100, (id + 1) % 100), null) as order_category_ids",
            "cast(null as array<bigint>) as order_product_ids",
            "if(id % 4 = 3, array(id % 100), null) as pay_category_ids",
            "cast(null as array<bigint>) as pay_product_ids",
            "0L as city_id",
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def test_facts_are_fixed_size_and_combined_before_the_shuffle(spark, hot_log, plan):
    params = TaskParams(DAY, DAY, keywords=("kw0",), category_ids=(1,))
    facts = sessions.session_facts(hot_log, params)
    text = plan(facts)
    assert "partial_min_by" in text and "partial_bool_or" in text or "partial_max" in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    columns = text[text.index("ReadSchema") :]
    assert "order_category_ids" not in columns and "page_id" not in columns
    hot = facts.where(F.col("session_id") == "hot").first()
    assert (hot.step_length, hot.keyword_hit, hot.category_hit) == (HOT_ROWS, True, True)


def test_a_hot_session_is_split_in_the_detail_join(spark, hot_log, plan, tmp_path):
    wanted = stored(hot_log.select("session_id").distinct(), str(tmp_path / "wanted"))
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50kb",
    ):
        detail = sessions.actions_of(hot_log, wanted)
        text = plan(detail)
        assert "skew=true" in text
        assert detail.count() == HOT_ROWS + OTHER_ROWS


def test_categories_are_combined_before_the_shuffle(spark, hot_log, plan):
    counts = categories.category_counts(categories.session_categories(hot_log))
    text = plan(counts)
    assert text.count("partial_count") >= 1 and "partial_sum" in text and "SortAggregate" not in text
    assert counts.agg(F.sum("click_count"), F.sum("order_count"), F.sum("pay_count")).first()[:] == (
        45_000,
        90_000,
        45_000,
    )


def test_a_hot_user_is_combined_before_the_blacklist_join(spark, plan):
    clicks = spark.range(0, 90_000, 1, 8).selectExpr(
        "timestamp_seconds(1709251200 + id % 3600) as click_time",
        f"date'{DAY}' as date",
        "concat('p', id % 3) as province",
        "concat('c', id % 3) as city",
        "if(id % 3 = 0, -1, id) as user_id",
        "id % 5 as ad_id",
    )
    cells = ads.click_cells(clicks)
    banned = spark.createDataFrame([(-1,)], "user_id bigint")
    kept = ads.user_click_counts(ads.without_users(cells, banned))
    text = plan(kept)
    below_join = text[text.index("Join") :]
    assert "partial_count" in below_join
    assert kept.agg(F.sum("click_count")).first()[0] == 60_000
