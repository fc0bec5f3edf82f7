"""From actions to sessions: roll-up, user attributes, filter and detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import predicates as p
from clickloom.functions import times
from clickloom.params import TaskParams
from clickloom.schemas import schema_of

USER_ATTRIBUTES = ("age", "professional", "city", "sex")
DETAIL_COLUMNS = tuple(f.name for f in schema_of("session_detail") if f.name not in ("task_id", "source"))


_SPAN, _HALF = 1 << 64, 1 << 63


def _first_user() -> Column:
    """The user of the earliest action that has one, the smallest if several share that time.

    Time and user form one number of fixed size, so the aggregation stays hash-based and a rerun finds the same user.
    """
    number = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    key = F.unix_micros("action_time").cast("decimal(38,0)") * number(_SPAN) + (F.col("user_id").cast("decimal(38,0)") + number(_HALF))
    return (F.pmod(F.min(key.cast("decimal(38,0)")), number(_SPAN)) - number(_HALF)).cast("bigint")


def _facts() -> list[Column]:
    return [
        _first_user().alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _with_visit_length(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("visit_length", times.seconds_between(F.col("start_time"), F.col("end_time")))


def session_facts(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session in fixed-size columns.

    Keyword and category conditions are answered while aggregating, as flags, so that no list of
    words or ids travels with a session: every buffer has a fixed size and a session holding a
    large share of the log shrinks to one row per map task before the shuffle.
    """
    aggregates = _facts()
    if params is not None:
        flags = {"keyword_hit": p.keyword_searched(params), "category_hit": p.category_clicked(params)}
        aggregates += [F.bool_or(c).alias(name) for name, c in flags.items() if c is not None]
    return _with_visit_length(actions.groupBy("session_id").agg(*aggregates))


def session_rollup(actions: DataFrame) -> DataFrame:
    """``session_facts`` plus the sorted sets of searched words and clicked categories."""
    return _with_visit_length(
        actions.groupBy("session_id").agg(
            *_facts(),
            F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
            F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        )
    )


def with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's attributes; a session of an unknown user is dropped.

    ``user_id`` is unique in ``users``. A user with very many sessions only makes the session side
    uneven, which adaptive skew splitting handles.
    """
    return sessions.join(users.select("user_id", *USER_ATTRIBUTES), "user_id")


def wanted_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions that meet every given parameter."""
    sessions = with_user(session_facts(actions, params), users)
    kept = sessions.where(
        p.all_of(
            p.age_in_range(params),
            p.professional_wanted(params),
            p.city_wanted(params),
            p.sex_wanted(params),
            None if params.keywords is None else F.col("keyword_hit"),
            None if params.category_ids is None else F.col("category_hit"),
        )
    )
    return kept.drop("keyword_hit", "category_hit")


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The detail rows of the given sessions, each action once.

    Pass sessions read from a table. Where they are too many to broadcast, both sides are then shuffled
    for this join alone, and adaptive execution can split a session that holds a large share of the log;
    it cannot when the sessions come straight out of an aggregation by session.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi").select(*DETAIL_COLUMNS)
