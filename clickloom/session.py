"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the analytics assume: UTC times, adaptive execution, stream state on disk.

    Partition counts and memory belong to the cluster; pass them in ``conf`` with dots
    written as double underscores, e.g. ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Only a session on one machine may go without: a temporary folder is chosen there. Elsewhere executors would
    not see each other's files, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="clickloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch folder that is removed when the work in it is done."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        files, target = located(spark, path)
        files.delete(target, True)


def located(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a written table, for a frame that is used more than once.

    It is computed once, survives lost executors, and from its files Spark knows its size when it
    chooses a join.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
