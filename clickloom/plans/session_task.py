"""The batch job: one task's five result tables from the action log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import categories, pages, sampling, sessions, stats
from clickloom.params import DEFAULT_EXTRACT_TOTAL, TaskParams
from clickloom.session import scratch_folder, stored
from clickloom.sinks.tables import TaskTables
from clickloom.sources.tables import find_task, scan_actions


@dataclass(frozen=True)
class SessionTables:
    """Where a task reads from."""

    action_log: DataFrame
    users: DataFrame
    tasks: DataFrame


def extracted_sessions(wanted: DataFrame, total: int, seed: int, scratch: str) -> DataFrame:
    """Draw up to ``total`` of the wanted sessions, spread over days and hours."""
    draws = sampling.session_draws(wanted, seed)
    cuts = stored(sampling.extract_cuts(draws, total), f"{scratch}/cuts")
    return stored(sampling.random_extract(draws, cuts), f"{scratch}/extracted")


def run_session_task(
    spark: SparkSession,
    task_id: int,
    tables: SessionTables,
    results: TaskTables,
    extract_total: int = DEFAULT_EXTRACT_TOTAL,
    seed: int = 0,
) -> TaskParams:
    """Run task ``task_id`` and write its results; with a page flow among its parameters, the conversion of the wanted sessions along it, too.

    The log is scanned three times, each time for other columns: for the session facts, for the
    category counts, and for the detail rows of the few sessions that were picked. A page flow takes one more scan.
    """
    params = find_task(tables.tasks, task_id)
    actions = scan_actions(tables.action_log, params)
    with scratch_folder(spark, f"session-task-{task_id}") as scratch:
        _write_results(task_id, actions, tables.users, params, results, scratch, extract_total, seed)
    return params


def _write_results(
    task_id: int,
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    results: TaskTables,
    scratch: str,
    extract_total: int,
    seed: int,
) -> None:
    wanted = stored(sessions.wanted_sessions(actions, users, params), f"{scratch}/wanted")
    results.write_task_rows(stats.session_aggr_stat(wanted), "session_aggr_stat", task_id)

    pairs = categories.of_sessions(categories.session_categories(actions), wanted)
    pairs = stored(pairs, f"{scratch}/pairs")
    hottest = stored(categories.top_categories(categories.category_counts(pairs)), f"{scratch}/hottest")
    results.write_task_rows(hottest, "top10_category", task_id)
    busiest = stored(categories.top_sessions(pairs, hottest), f"{scratch}/busiest")
    results.write_task_rows(busiest, "top10_session", task_id)

    if params.page_flow:
        views = actions.select("session_id", "page_id", "action_time").join(wanted.select("session_id"), "session_id")
        results.write_task_rows(pages.page_conversion(views, params.page_flow), "page_conversion", task_id)

    extracted = extracted_sessions(wanted, extract_total, seed, scratch)
    picked = extracted.select("session_id", F.lit("extract").alias("source")).unionByName(
        busiest.select("session_id", F.lit("top10").alias("source")).distinct()
    )
    # (session_id, source) is unique, so each action appears once per source.
    detail = stored(actions.join(stored(picked, f"{scratch}/picked"), "session_id"), f"{scratch}/detail")
    results.write_task_rows(detail, "session_detail", task_id, by=("source",))
    report = sampling.extract_report(extracted, detail.where(F.col("source") == "extract"))
    results.write_task_rows(report, "session_random_extract", task_id)
