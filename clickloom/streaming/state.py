"""Tables that a stream adds to, one folder per micro-batch.

Each folder is written with overwrite from the batch and the folders before it, so a batch that runs
again leaves the same files. Batch ids count up from 0 without gaps as long as the stream keeps its
checkpoint; tables and checkpoint therefore live and are removed together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.schemas import schema_of
from clickloom.session import located

FOLD_EVERY = 64


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = located(spark, path)
    return files.exists(target)


def mark_finished(spark: SparkSession, root: str, batch_id: int) -> None:
    """Note that all tables of ``batch_id`` are written; notes other than this one and the one before go."""
    files, target = located(spark, f"{root}/finished/{batch_id}")
    files.create(target, True).close()
    for found in files.listStatus(target.getParent()):
        name = found.getPath().getName()
        if name.isdigit() and int(name) < batch_id - 1:
            files.delete(found.getPath(), False)


def last_batch(spark: SparkSession, root: str) -> int:
    """The last micro-batch whose tables are all written; raises LookupError before the first."""
    files, target = located(spark, f"{root}/finished")
    names = [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []
    finished = [int(name) for name in names if name.isdigit()]
    if not finished:
        raise LookupError(f"no finished batch in {root}")
    return max(finished)


class _BatchFolders:
    def __init__(self, spark: SparkSession, root: str, table: str, fold_every: int = FOLD_EVERY) -> None:
        self.spark, self.fold_every = spark, fold_every
        self.schema: StructType = schema_of(table)
        self.root = f"{root}/{table}"

    def _batch_path(self, batch_id: int) -> str:
        return f"{self.root}/batches/{batch_id}"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._batch_path(batch_id))

    def added(self, batch_id: int) -> DataFrame:
        """What a batch has written."""
        return self._batches([batch_id])

    def _batches(self, ids: Iterable[int]) -> DataFrame:
        paths = [self._batch_path(i) for i in ids]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _last_fold(self, batch_id: int, level: int = 1) -> int:
        """Batches below this id are in the folded part when ``batch_id`` runs."""
        every = self.fold_every**level
        return batch_id // every * every

    def _folds_at(self, batch_id: int, level: int = 1) -> bool:
        return batch_id > 0 and batch_id % self.fold_every**level == 0

    def _remove(self, path: str) -> None:
        """Delete what ``path`` matches; gone already is fine, as a batch may run again."""
        files, target = located(self.spark, path)
        for found in files.globStatus(target) or ():
            files.delete(found.getPath(), True)

    def _remove_batches(self, folded_at: int) -> None:
        """Delete the batches that the fold before the one at ``folded_at`` has taken in: one period is kept for retries."""
        for i in range(max(0, folded_at - 2 * self.fold_every), folded_at - self.fold_every):
            self._remove(self._batch_path(i))


class DailyCounts(_BatchFolders):
    """Counts by date and further keys, kept as per-batch parts that combine into running totals.

    Batches are folded ``fold_every`` at a time into parts ``folded1/date=…/upto=…``, and as many of those into
    parts of ``folded2``. Reading a day therefore meets at most ``fold_every`` batches, ``fold_every`` parts of the
    first level and, at 64, four or five of the second. What has been folded is deleted one period later.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        table: str,
        combine: Callable[[str], Column] = F.sum,
        fold_every: int = FOLD_EVERY,
    ) -> None:
        super().__init__(spark, root, table, fold_every)
        self.keys = [name for name in self.schema.names if name != "click_count"]
        self.combine = combine

    def _folded_path(self, level: int) -> str:
        return f"{self.root}/folded{level}"

    def _combined(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(self.combine("click_count").alias("click_count"))

    def fold(self, batch_id: int) -> None:
        """Call before ``batch_id`` is written; does something every ``fold_every`` batches."""
        if self._folds_at(batch_id):
            self._write_fold(self._batches(range(batch_id - self.fold_every, batch_id)), batch_id, 1)
            self._remove_batches(batch_id)
        if self._folds_at(batch_id, 2):
            period = self.fold_every**2
            parts = self._folded(1, batch_id - period, batch_id)
            if parts is not None:
                self._write_fold(parts, batch_id, 2)
            for upto in range(max(0, batch_id - 2 * period) + self.fold_every, batch_id - period + 1, self.fold_every):
                self._remove(f"{self._folded_path(1)}/date=*/upto={upto}")

    def _write_fold(self, rows: DataFrame, upto: int, level: int) -> None:
        (
            self._combined(rows)
            .withColumn("upto", F.lit(upto).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "upto")
            .parquet(self._folded_path(level))
        )

    def _folded(self, level: int, above: int, upto: int) -> DataFrame | None:
        """The parts of a level for batches from ``above`` to below ``upto``."""
        path = self._folded_path(level)
        if upto <= above or not _exists(self.spark, path):
            return None
        stored = StructType([*self.schema, StructField("upto", LongType())])
        parts = self.spark.read.schema(stored).parquet(path)
        return parts.where((F.col("upto") > above) & (F.col("upto") <= upto)).select(*self.schema.names)

    def totals(
        self, batch_id: int, dates: Iterable[str] | None = None, touched: Sequence[str] = ()
    ) -> DataFrame:
        """Running totals after ``batch_id``, for the given dates, or just for what the batch has added to: the rows that share its
        values of the ``touched`` columns, ``date`` among them."""
        first, second = self._last_fold(batch_id), self._last_fold(batch_id, 2)
        parts = [
            self._batches(range(first, batch_id + 1)),
            self._folded(1, second, first),
            self._folded(2, 0, second),
        ]
        rows = reduce(DataFrame.unionByName, (part for part in parts if part is not None))
        if dates is not None:
            rows = rows.where(F.col("date").isin([date.fromisoformat(d) for d in dates]))
        if touched:
            added = self.added(batch_id).select(*touched)
            # Days between the years -6060 and 9999, so a few million at the very most; they prune the folded parts.
            rows = rows.join(F.broadcast(added.select("date").distinct()), "date", "left_semi")
            rows = rows.join(added, list(touched), "left_semi")
        return self._combined(rows)


class BannedUsers(_BatchFolders):
    """The blacklist. Users are added once and stay for good; a fold carries the whole list forward."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = FOLD_EVERY) -> None:
        super().__init__(spark, root, "ad_blacklist", fold_every)

    def _folded_path(self, upto: int) -> str:
        return f"{self.root}/folded/{upto}"

    def fold(self, batch_id: int) -> None:
        if self._folds_at(batch_id):
            users = self._since_fold(batch_id - self.fold_every, batch_id)
            users.write.mode("overwrite").parquet(self._folded_path(batch_id))
            self._remove(self._folded_path(batch_id - 2 * self.fold_every))
            self._remove_batches(batch_id)

    def _since_fold(self, upto: int, batch_id: int) -> DataFrame:
        users = self._batches(range(upto, batch_id))
        if upto:
            users = users.unionByName(self.spark.read.schema(self.schema).parquet(self._folded_path(upto)))
        return users

    def before(self, batch_id: int) -> DataFrame:
        """While ``batch_id`` runs: users banned by earlier batches, whether or not it has run before."""
        return self._since_fold(self._last_fold(batch_id), batch_id)

    def after(self, batch_id: int) -> DataFrame:
        """Users banned up to and including ``batch_id``, which has finished."""
        return self._since_fold(self._last_fold(batch_id), batch_id + 1)
