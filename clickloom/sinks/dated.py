"""A table partitioned by date that takes in rows by key, rewriting only the dates it is given."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.upsert import upsert_accumulate, upsert_replace
from clickloom.schemas import conform, schema_of
from clickloom.session import located

Merge = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class DatedTable:
    """An ordinary Parquet folder ``root/table/date=…``, which any reader can use.

    A batch's merged dates are first written to ``root/table_batches/<batch>`` and then put in place by a dynamic partition overwrite. A batch
    that runs again finds its merged dates complete and only puts them in place again, so that nothing is added twice; one that failed before that
    starts anew from dates it had not touched. The dates of the latest batch are kept for that, older ones are removed. While a batch
    puts its dates in place, a reader may miss them for a moment. Batch numbers rise.
    """

    spark: SparkSession
    root: str
    table: str

    @property
    def keys(self) -> list[str]:
        return [name for name in schema_of(self.table).names if name != "click_count"]

    @property
    def path(self) -> str:
        return f"{self.root}/{self.table}"

    def _batch_path(self, batch_id: int) -> str:
        return f"{self.path}_batches/{batch_id}"

    def _exists(self, path: str) -> bool:
        files, target = located(self.spark, path)
        return files.exists(target)

    def read(self, path: str | None = None) -> DataFrame:
        schema = schema_of(self.table)
        path = path or self.path
        if not self._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def replace(self, incoming: DataFrame, batch_id: int) -> None:
        """Rows of ``incoming`` replace those of equal keys. ``incoming`` has each key once."""
        self._take_in(incoming, batch_id, upsert_replace)

    def accumulate(self, incoming: DataFrame, batch_id: int) -> None:
        """The counts of equal keys are added up."""
        self._take_in(incoming, batch_id, upsert_accumulate)

    def _take_in(self, incoming: DataFrame, batch_id: int, merge: Merge) -> None:
        batch = self._batch_path(batch_id)
        if not self._exists(f"{batch}/_SUCCESS"):
            incoming = conform(incoming, self.table)
            # a batch's days, so that the other days' folders are not even listed for reading
            days = [r.date for r in incoming.select("date").distinct().collect()]
            merged = merge(self.read().where(F.col("date").isin(days)), incoming, self.keys)
            merged.select(*schema_of(self.table).names).write.mode("overwrite").partitionBy("date").parquet(batch)
        self._put_in_place(batch)
        files, target = located(self.spark, batch)
        for found in files.listStatus(target.getParent()):
            name = found.getPath().getName()
            if name.isdigit() and int(name) < batch_id:
                files.delete(found.getPath(), True)

    def _put_in_place(self, batch: str) -> None:
        rows = self.read(batch).repartition("date")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(self.path)
