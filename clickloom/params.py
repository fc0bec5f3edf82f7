"""Parameters of one session-analysis task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

DEFAULT_EXTRACT_TOTAL = 100


def _joined(values: Mapping[str, Sequence[str | None] | None], name: str) -> str | None:
    """All elements of a parameter's JSON array as one comma list; absent or blank gives None."""
    given = [v for v in values.get(name) or () if v not in (None, "")]
    return ",".join(given) or None


def _listed(values: Mapping[str, Sequence[str | None] | None], name: str) -> tuple[str, ...] | None:
    text = _joined(values, name)
    return None if text is None else tuple(v for v in text.split(",") if v)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _id_or_none(text: str) -> int | None:
    try:
        return int(text)
    except ValueError:
        return None


@dataclass(frozen=True)
class TaskParams:
    """What the user asked for. A field left at None puts no condition on the sessions."""

    start_date: date
    end_date: date
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    page_flow: tuple[int, ...] | None = None

    @classmethod
    def from_json_map(cls, values: Mapping[str, Sequence[str | None] | None]) -> TaskParams:
        """Build from the decoded ``task_param`` JSON, whose values are arrays of strings."""
        start, end = _joined(values, "startDate"), _joined(values, "endDate")
        if start is None or end is None:
            raise ValueError("task parameters need both startDate and endDate")
        ids, pages = _listed(values, "categoryIds"), _listed(values, "targetPageFlow")
        return cls(
            start_date=date.fromisoformat(start),
            end_date=date.fromisoformat(end),
            start_age=_number(_joined(values, "startAge")),
            end_age=_number(_joined(values, "endAge")),
            professionals=_listed(values, "professionals"),
            cities=_listed(values, "cities"),
            sex=_joined(values, "sex"),
            keywords=_listed(values, "keywords"),
            # An id that is no number can match no category, so it is left out of the list.
            page_flow=None if pages is None else tuple(map(int, pages)),
            category_ids=None if ids is None else tuple(i for i in map(_id_or_none, ids) if i is not None),
        )
