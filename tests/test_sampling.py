from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from clickloom.operators import sampling

START = datetime(2024, 3, 1)


def _frame(spark, started):
    return spark.createDataFrame(list(started), "session_id string, start_time timestamp")


def _extract(sessions, total=100, seed=0):
    draws = sampling.session_draws(sessions, seed)
    return sampling.random_extract(draws, sampling.extract_cuts(draws, total))


def _expected(started, total, seed):
    """The definition, in plain Python."""
    hours = defaultdict(list)
    for session_id, time in started:
        hours[time.date(), time.hour].append(session_id)
    days = defaultdict(int)
    for (day, _), ids in hours.items():
        days[day] += len(ids)
    picked = set()
    for (day, _), ids in hours.items():
        quota = min(int(len(ids) / days[day] * (total // len(days))), len(ids))
        picked |= set(sorted(ids, key=lambda s: (hashlib.md5(f"{seed}:{s}".encode()).hexdigest(), s))[:quota])
    return picked


@pytest.mark.parametrize("total", [1, 7, 100, 500, 2000, 100_000])
def test_extract_equals_the_definition(spark, total):
    rng = random.Random(3)
    started = [
        (f"s{i}", START + timedelta(days=rng.randrange(3), hours=rng.choice([8, 8, 8, 9, 20]))) for i in range(1500)
    ]
    got = _extract(_frame(spark, started), total, seed=5)
    ids = [r.session_id for r in got.collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) == _expected(started, total, 5)


def test_one_hour_with_nearly_all_sessions(spark):
    started = [(f"s{i}", START) for i in range(20_000)] + [("late", START + timedelta(hours=5))]
    got = _extract(_frame(spark, started), 9_000, seed=1)
    assert {r.session_id for r in got.collect()} == _expected(started, 9_000, 1)


def test_the_seed_decides(spark, rows):
    frame = _frame(spark, [(f"s{i}", START) for i in range(300)])
    first, again, other = (rows(_extract(frame, 50, seed)) for seed in (1, 1, 2))
    assert first == again != other and len(first) == len(other) == 50


def test_more_days_than_sessions_to_draw_gives_none(spark):
    started = [(f"s{i}", START + timedelta(days=i)) for i in range(101)]
    assert _extract(_frame(spark, started), 100).count() == 0


def test_no_sessions(spark):
    assert _extract(_frame(spark, [])).count() == 0


def test_quota_never_exceeds_the_hour(spark, rows):
    started = [("a", START), ("b", START), ("c", START + timedelta(hours=1))]
    hours = sampling.hour_counts(_frame(spark, started))
    assert rows(sampling.hour_quotas(hours, 100), "hour", "hour_sessions", "day_sessions", "quota") == [
        (0, 2, 3, 2),
        (1, 1, 3, 1),
    ]


def test_report(spark):
    from frames import action, actions

    extracted = _frame(spark, [("s", START)])
    detail = actions(
        spark,
        action("s", search_keyword="b"),
        action("s", search_keyword="a", click_category_id=11),
        action("s", search_keyword="a", click_category_id=1),
    )
    assert tuple(sampling.extract_report(extracted, detail).first()) == ("s", START, ["a", "b"], [1, 11])
