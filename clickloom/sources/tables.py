"""Scans of the action log, the user table and the task table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField

from clickloom.functions import times
from clickloom.functions.values import clicked_id, id_list
from clickloom.params import TaskParams
from clickloom.schemas import schema_of


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet folder when ``source`` looks like a path, otherwise a catalog table or view."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table, for the small task and user tables kept there.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a large one in parallel.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def in_date_range(log: DataFrame, params: TaskParams) -> DataFrame:
    """Rows of the wanted days, both ends included.

    The condition is on the stored ``date`` column itself, so it prunes partitions of a log laid out
    by date and is otherwise pushed to the Parquet scan. A text column compares as text.
    """
    is_text = log.schema["date"].dataType.typeName() == "string"
    start, end = params.start_date, params.end_date
    return log.where(F.col("date").between(*((str(start), str(end)) if is_text else (start, end))))


def typed_actions(log: DataFrame) -> DataFrame:
    """The action log with typed columns: text times and comma lists parsed, "no click" marks as null.

    Columns that are typed already are taken as they are.
    """
    stored = log.schema

    def typed(field: StructField) -> Column | str:
        name, kind = field.name, stored[field.name].dataType
        if name.startswith("click_"):
            return clicked_id(F.col(name)).alias(name)
        if kind == field.dataType:
            return name
        if isinstance(field.dataType, ArrayType):
            return id_list(F.col(name)).alias(name)
        if name == "action_time":
            return times.parse_time(F.col(name)).alias(name)
        return F.col(name).cast(field.dataType).alias(name)

    return log.select(*(typed(field) for field in schema_of("user_visit_action")))


def scan_actions(log: DataFrame, params: TaskParams) -> DataFrame:
    return typed_actions(in_date_range(log, params))


def find_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """The parameters of one task; raises LookupError when there is no such task."""
    found = (
        tasks.where(F.col("task_id") == task_id)
        .select(F.from_json("task_param", "map<string, array<string>>").alias("param"))
        .take(1)
    )
    if not found:
        raise LookupError(f"no task with id {task_id}")
    if found[0].param is None:
        raise ValueError(f"task {task_id} has no readable parameters")
    return TaskParams.from_json_map(found[0].param)
