from __future__ import annotations

from datetime import date

import pytest

from clickloom.params import TaskParams
from clickloom.schemas import schema_of
from clickloom.sources.tables import find_task

DAYS = {"startDate": ["2024-01-05"], "endDate": ["2024-01-20"]}


def test_absent_parameters_set_no_condition():
    params = TaskParams.from_json_map(DAYS)
    assert params == TaskParams(date(2024, 1, 5), date(2024, 1, 20))


def test_one_joined_element_and_many_elements_are_the_same():
    one = TaskParams.from_json_map(DAYS | {"keywords": ["a,b"], "categoryIds": ["3,15"]})
    many = TaskParams.from_json_map(DAYS | {"keywords": ["a", "b"], "categoryIds": ["3", "15"]})
    assert one == many
    assert one.keywords == ("a", "b") and one.category_ids == (3, 15)


@pytest.mark.parametrize("blank", [None, [], [None], [""]])
def test_blank_parameters_count_as_absent(blank):
    assert TaskParams.from_json_map(DAYS | {"cities": blank, "startAge": blank}).cities is None


def test_an_id_that_is_no_number_matches_nothing_but_still_is_a_condition():
    assert TaskParams.from_json_map(DAYS | {"categoryIds": ["x"]}).category_ids == ()


@pytest.mark.parametrize("missing", ["startDate", "endDate"])
def test_both_dates_are_needed(missing):
    with pytest.raises(ValueError):
        TaskParams.from_json_map({k: v for k, v in DAYS.items() if k != missing})


def _tasks(spark, *params):
    rows = [(i, "t", None, None, None, None, None, text) for i, text in enumerate(params, 1)]
    return spark.createDataFrame(rows, schema_of("task"))


def test_find_task(spark):
    text = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"startAge":["10"],"endAge":["50"],"sex":["male"]}'
    params = find_task(_tasks(spark, "{}", text), 2)
    assert (params.start_age, params.end_age, params.sex) == (10, 50, "male")


def test_a_missing_task_raises(spark):
    with pytest.raises(LookupError):
        find_task(_tasks(spark, "{}"), 9)


def test_unreadable_parameters_raise(spark):
    with pytest.raises(ValueError):
        find_task(_tasks(spark, "no json"), 1)
