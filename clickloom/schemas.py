"""Column names and types of every input and result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VISIT_BUCKETS = ("1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m")
STEP_BUCKETS = ("1_3", "4_6", "7_9", "10_30", "30_60", "60")

_LONG, _INT, _DOUBLE, _TEXT = LongType(), IntegerType(), DoubleType(), StringType()
_DATE, _TIME, _IDS = DateType(), TimestampType(), ArrayType(LongType())

_DETAIL: dict[str, DataType] = {
    "user_id": _LONG,
    "session_id": _TEXT,
    "page_id": _LONG,
    "action_time": _TIME,
    "search_keyword": _TEXT,
    "click_category_id": _LONG,
    "click_product_id": _LONG,
    "order_category_ids": _IDS,
    "order_product_ids": _IDS,
    "pay_category_ids": _IDS,
    "pay_product_ids": _IDS,
}

_TABLES: dict[str, dict[str, DataType]] = {
    # inputs
    "user_visit_action": {"date": _DATE, **_DETAIL, "city_id": _LONG},
    "user_info": {
        "user_id": _LONG,
        "username": _TEXT,
        "name": _TEXT,
        "age": _INT,
        "professional": _TEXT,
        "city": _TEXT,
        "sex": _TEXT,
    },
    "task": {
        "task_id": _LONG,
        "task_name": _TEXT,
        "create_time": _TEXT,
        "start_time": _TEXT,
        "finish_time": _TEXT,
        "task_type": _TEXT,
        "task_status": _TEXT,
        "task_param": _TEXT,
    },
    # results of a session task
    "session_aggr_stat": {
        "task_id": _LONG,
        "session_count": _LONG,
        **{f"visit_length_{b}_ratio": _DOUBLE for b in VISIT_BUCKETS},
        **{f"step_length_{b}_ratio": _DOUBLE for b in STEP_BUCKETS},
    },
    "session_random_extract": {
        "task_id": _LONG,
        "session_id": _TEXT,
        "start_time": _TIME,
        "search_keywords": ArrayType(_TEXT),
        "click_category_ids": _IDS,
    },
    "session_detail": {"task_id": _LONG, "source": _TEXT, **_DETAIL},
    "top10_category": {
        "task_id": _LONG,
        "category_id": _LONG,
        "click_count": _LONG,
        "order_count": _LONG,
        "pay_count": _LONG,
    },
    "page_conversion": {
        "task_id": _LONG,
        "step": _INT,
        "page_id": _LONG,
        "next_page": _LONG,
        "jumps": _LONG,
        "base": _LONG,
        "rate": _DOUBLE,
    },
    "top10_session": {"task_id": _LONG, "category_id": _LONG, "session_id": _TEXT, "click_count": _LONG},
    # results of the ad-click streams
    "ad_blacklist": {"user_id": _LONG},
    "ad_user_click_count": {"date": _DATE, "user_id": _LONG, "ad_id": _LONG, "click_count": _LONG},
    "ad_stat": {"date": _DATE, "province": _TEXT, "city": _TEXT, "ad_id": _LONG, "click_count": _LONG},
    "ad_province_top3": {"date": _DATE, "province": _TEXT, "ad_id": _LONG, "click_count": _LONG},
    "ad_click_pane": {"date": _DATE, "pane": _TIME, "ad_id": _LONG, "click_count": _LONG},
    "ad_click_arrivals": {"date": _DATE, "click_count": _LONG},
    "ad_click_trend": {"date": _DATE, "hour": _TEXT, "minute": _TEXT, "ad_id": _LONG, "click_count": _LONG},
}


def schema_of(table: str) -> StructType:
    return StructType([StructField(name, kind) for name, kind in _TABLES[table].items()])


def conform(df: DataFrame, table: str, **constants: object) -> DataFrame:
    """``df`` with exactly the columns and types of ``table``; ``constants`` fill fixed columns."""
    columns: list[Column] = []
    for field in schema_of(table):
        value = F.lit(constants[field.name]) if field.name in constants else F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
