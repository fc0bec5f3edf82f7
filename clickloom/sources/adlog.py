"""The ad-click log: stream sources and line parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import times

FIELDS = ("millis", "province", "city", "user_id", "ad_id")  # fixed order of a line's fields
LAST_MILLIS, LAST_ID = 253402300799999, 2**63 - 1  # the end of the year 9999; the largest 64-bit number


def _number(limit: int) -> str:
    """A pattern for whole numbers of either sign up to ``limit``, so that reading one cannot overflow."""
    digits = str(limit)
    as_long = [
        rf"{digits[:i]}[0-{int(d) - 1}]\d{{{len(digits) - i - 1}}}" for i, d in enumerate(digits) if d != "0"
    ]
    return rf"[+-]?(?:\d{{1,{len(digits) - 1}}}|{'|'.join(as_long)}|{digits})"


# A line with its numbers in place; anything after the fifth field is ignored.
READABLE = rf"^{_number(LAST_MILLIS)} [^ ]*+ [^ ]*+ {_number(LAST_ID)} {_number(LAST_ID)}(?: |$)"


def kafka_lines(spark: SparkSession, brokers: str, topics: str, **options: str) -> DataFrame:
    """Log lines from Kafka; ``topics`` is a comma list. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    records = reader.option("subscribe", topics).options(**options).load()
    return records.select(F.col("value").cast("string").alias("line"))


def file_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Log lines from text files as they appear under ``path``."""
    return spark.readStream.options(**options).text(path).select(F.col("value").alias("line"))


#: Why a line is dropped, in the order in which it is looked at.
DEFECTS = ("empty", "short", "time", "user", "ad")


def line_defect(line: Column) -> Column:
    """Why ``line`` is dropped, one of DEFECTS; null for a readable line. A null line is empty."""
    parts = F.split(line, " ")
    number = lambda name, limit: F.get(parts, FIELDS.index(name)).rlike(f"^{_number(limit)}$")
    return (
        F.when(line.isNull() | (line == ""), "empty")
        .when(line.rlike(READABLE), None)
        .when(F.size(parts) < len(FIELDS), "short")
        .when(~number("millis", LAST_MILLIS), "time")
        .when(~number("user_id", LAST_ID), "user")
        .otherwise("ad")
    )


def observed_lines(lines: DataFrame, metrics: str | Observation) -> DataFrame:
    """``lines``, counting on the way: ``lines`` in all, ``dropped``, and ``dropped_…`` for each of DEFECTS."""
    defect = line_defect(F.col("line"))
    counts = [F.count_if(defect == d).alias(f"dropped_{d}") for d in DEFECTS]
    return lines.observe(metrics, F.count(F.lit(1)).alias("lines"), F.count(defect).alias("dropped"), *counts)


def log_quality(spark: SparkSession, observation: Observation) -> DataFrame:
    """(reason, lines) of an observation by ``observed_lines`` whose lines have been read: all lines, and those dropped for each reason."""
    found = observation.get
    rows = [("all", found["lines"]), *((d, found[f"dropped_{d}"]) for d in DEFECTS)]
    return spark.createDataFrame(rows, "reason string, lines bigint")


def parse_ad_log(lines: DataFrame, metrics: str | Observation | None = "ad_log") -> DataFrame:
    """Typed clicks from ``line``. Lines that are short or whose numbers do not read are dropped.

    The numbers of lines and of dropped lines by reason are observed under the name ``metrics``; a stream reports them in its
    progress, and ``log_quality`` makes rows of an Observation. None observes nothing. Times after LAST_MILLIS count as unreadable, as they have no date of four digits.
    """
    readable = F.col("line").rlike(READABLE)
    if metrics is not None:
        lines = observed_lines(lines, metrics)
    # One pattern decides on the raw line, so that the line is split once and only when it is kept.
    parts = F.split("line", " ")
    field = {name: F.get(parts, i) for i, name in enumerate(FIELDS)}
    clicks = lines.where(readable).select(
        times.from_epoch_millis(field["millis"].cast("bigint")).alias("click_time"),
        field["province"].alias("province"),
        field["city"].alias("city"),
        field["user_id"].cast("bigint").alias("user_id"),
        field["ad_id"].cast("bigint").alias("ad_id"),
    )
    return clicks.select(
        "click_time", F.to_date("click_time").alias("date"), "province", "city", "user_id", "ad_id"
    )
