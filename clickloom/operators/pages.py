"""Page-to-page conversion along a flow of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_jumps(actions: DataFrame, partitions: int | None = None) -> DataFrame:
    """(page_id, next_page, jumps): how often one page follows another in a session, by (action_time, page_id).

    The views are ordered by ranges of (session, time, page), which are about equally large however the log is spread: a session or an hour with much
    of it falls into several. Neighbours are found within a range; then the last view of a range meets the first one of
    the next range that has any. That second step sees two rows for each range.
    """
    order = ["session_id", "action_time", "page_id"]
    parts = partitions or int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    views = actions.select(*order).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    inside = W.partitionBy("part").orderBy(*order)
    # a view is never null as a whole, so a missing neighbour has no row number
    views = views.withColumn("place", F.lit(1))
    seen = views.select(
        "part",
        "session_id",
        "page_id",
        *(F.lead(c).over(inside).alias(f"next_{c}") for c in ("place", "session_id", "page_id")),
        F.lag("place").over(inside).alias("before"),
    )
    near = seen.where("next_place = 1 and session_id <=> next_session_id").select("page_id", F.col("next_page_id").alias("next_page"))
    ends = seen.where("next_place is null or before is null").select("part", "session_id", "page_id", F.col("next_place").isNull().alias("is_last"))
    by_range = W.orderBy("part", "is_last")
    ends = ends.select("page_id", "session_id", "is_last", F.lead("session_id").over(by_range).alias("next_session_id"), F.lead("page_id").over(by_range).alias("next_page"))
    # where a range has one view, it is both its first and its last
    across = ends.where("is_last and session_id <=> next_session_id").select("page_id", "next_page")
    jumps = near.unionByName(across).where("next_page is not null")
    return jumps.groupBy("page_id", "next_page").agg(F.count(F.lit(1)).alias("jumps"))


def page_conversion(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """(step, page_id, next_page, jumps, base, rate) for each pair of neighbours in ``flow``.

    The base of the first step is how often its page was viewed, that of a later one the jumps of the step before; the rate is
    null where the base is 0.
    """
    spark = actions.sparkSession
    steps = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(flow, flow[1:], strict=False), 1)]
    steps = spark.createDataFrame(steps, "step int, page_id bigint, next_page bigint")
    views = actions.where(F.col("page_id") == F.lit(flow[0] if flow else None).cast("bigint")).agg(F.count(F.lit(1)).alias("views"))
    counted = steps.join(page_jumps(actions), ["page_id", "next_page"], "left").withColumn("jumps", F.coalesce("jumps", F.lit(0)))
    # a row for each step of the flow
    before = F.lag("jumps").over(W.orderBy("step"))
    based = counted.withColumn("before", before).withColumn("base", F.when(F.col("step") == 1, views.scalar()).otherwise(F.col("before")))
    rate = F.col("jumps") / F.nullif("base", F.lit(0).cast("bigint"))
    return based.select("step", "page_id", "next_page", "jumps", "base", F.round(rate, 4).alias("rate"))
