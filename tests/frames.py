"""Small hand-written input frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from clickloom.schemas import schema_of

DAY = date(2024, 3, 1)
BASE = datetime(2024, 3, 1, 10, 0, 0)

_ACTION = {f: None for f in schema_of("user_visit_action").names}


def action(session_id, second=0, user_id=1, day=DAY, base=BASE, **values):
    at = base + timedelta(seconds=second)
    row = _ACTION | {
        "date": day,
        "user_id": user_id,
        "session_id": session_id,
        "page_id": 1,
        "action_time": at,
        "city_id": 0,
    }
    return tuple((row | values).values())


def actions(spark, *rows):
    return spark.createDataFrame(list(rows), schema_of("user_visit_action"))


def users(spark, *rows):
    """Rows of (user_id, age, professional, city, sex)."""
    full = [(r[0], f"u{r[0]}", f"n{r[0]}", *r[1:]) for r in rows]
    return spark.createDataFrame(full, schema_of("user_info"))


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def log_line(when, province, city, user_id, ad_id):
    from datetime import timezone

    millis = int(when.replace(tzinfo=timezone.utc).timestamp() * 1000)
    return f"{millis} {province} {city} {user_id} {ad_id}"


class Recorder:
    """Stands in for a reader or writer and records what it is asked to do."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call
