"""Time the headline queries: one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import statistics
import time

from clickloom.plans.registry import queries
from clickloom.session import build_session

HEADLINE = (
    "action_scan",
    "action_scan_text",
    "session_rollup",
    "session_filter",
    "session_aggr_stat",
    "session_detail_filtered",
    "page_conversion",
    "top10_category",
    "top10_session",
    "top10_session_detail",
    "session_random_extract",
    "session_task",
    "ad_user_click_count",
    "ad_blacklist",
    "ad_filtered_clicks",
    "ad_trend_last_hour",
    "ad_stat",
    "ad_province_top3",
    "ad_click_trend",
    "ad_click_sliding",
    "ad_log_quality",
    "ad_upsert_stored",
    "ad_upsert_replace",
    "ad_upsert_accumulate",
    "ad_stream_tables",
    "ad_stream_trend",
    "ad_stream_running_stat",
)
ONCE = {"session_task", "ad_stream_tables", "ad_stream_trend", "ad_stream_running_stat"}
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}
    known["ad_stat"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not timed
    for name in only or HEADLINE:
        taken = []
        for _ in range(1 if name in ONCE else REPEATS):
            began = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
