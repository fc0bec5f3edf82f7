"""Result tables: Parquet folders, or database tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from clickloom.functions.values import as_text
from clickloom.schemas import conform, schema_of


class TaskTables(Protocol):
    """Where a task's result rows go."""

    def write_task_rows(self, df: DataFrame, table: str, task_id: int, by: tuple[str, ...] = ()) -> None: ...


@dataclass(frozen=True)
class ParquetTables:
    """Result tables as Parquet folders under one root."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write_task_rows(self, df: DataFrame, table: str, task_id: int, by: tuple[str, ...] = ()) -> None:
        """Add a task's rows. Other tasks' rows stay; running the same task again replaces its own."""
        rows = conform(df, table, task_id=task_id).drop("task_id")
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path(table)}/task_id={task_id}")

    def replace_groups(self, df: DataFrame, table: str, group: tuple[str, ...]) -> None:
        """Replace whole groups: every group found in ``df`` is emptied and written anew, the others stay."""
        (
            conform(df, table)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*group)
            .parquet(self.path(table))
        )

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        schema = schema_of(table)
        return spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)


@dataclass(frozen=True)
class JdbcTables:
    """Result tables in a database reachable by JDBC. Its driver must be on the class path.

    A task's rows are first written to a table of their own, in parallel, and then moved in one transaction that deletes what the task has
    written before. So a task can run again, whether it failed or not.
    """

    url: str
    options: dict[str, str] = field(default_factory=dict)

    def write_task_rows(self, df: DataFrame, table: str, task_id: int, by: tuple[str, ...] = ()) -> None:
        """Put a task's rows in the place of those it has written before. Lists are stored as comma text, as most databases have no list type."""
        staged, task_id = f"{table}_task_{int(task_id)}", int(task_id)
        rows = as_text(conform(df, table, task_id=task_id))
        self._write(rows, staged, "overwrite")
        columns = ", ".join(rows.columns)
        self._execute(
            df.sparkSession,
            f"DELETE FROM {table} WHERE task_id = {task_id}",
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staged}",
            f"DROP TABLE {staged}",
        )

    def publish(self, df: DataFrame, table: str) -> None:
        """Replace a table's content, keeping its definition: for the current state of a stream's tables."""
        self._write(as_text(conform(df, table)), table, "overwrite", truncate="true")

    def _execute(self, spark: SparkSession, *statements: str) -> None:
        """Run statements on the driver's own connection, all or none."""
        settings = spark._jvm.java.util.Properties()
        for name, value in self.options.items():
            settings.setProperty(name, value)
        if driver := self.options.get("driver"):
            spark._jvm.java.lang.Class.forName(driver)
        connection = spark._jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().executeUpdate(statement)
            connection.commit()
        finally:
            connection.close()

    def _write(self, rows: DataFrame, table: str, mode: str, **options: str) -> None:
        writer = rows.write.format("jdbc").options(url=self.url, dbtable=table, **self.options, **options)
        writer.mode(mode).save()
