"""Session conditions. Each returns None when its parameter is absent."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.params import TaskParams


def age_in_range(params: TaskParams) -> Column | None:
    """Inclusive on both ends; one bound alone is no condition."""
    if params.start_age is None or params.end_age is None:
        return None
    return F.col("age").between(params.start_age, params.end_age)


def professional_wanted(params: TaskParams) -> Column | None:
    return None if params.professionals is None else F.col("professional").isin(*params.professionals)


def city_wanted(params: TaskParams) -> Column | None:
    return None if params.cities is None else F.col("city").isin(*params.cities)


def sex_wanted(params: TaskParams) -> Column | None:
    return None if params.sex is None else F.col("sex") == params.sex


def keyword_searched(params: TaskParams) -> Column | None:
    """On one action: does it search a wanted word?"""
    return None if params.keywords is None else F.col("search_keyword").isin(*params.keywords)


def category_clicked(params: TaskParams) -> Column | None:
    """On one action: does it click a wanted category?"""
    return None if params.category_ids is None else F.col("click_category_id").isin(*params.category_ids)


def all_of(*conditions: Column | None) -> Column:
    """The conjunction of the conditions that apply; true when none does."""
    return reduce(and_, (c for c in conditions if c is not None), F.lit(True))
