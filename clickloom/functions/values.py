"""Id lists, the no-value marker, ratios and text rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, TimestampType

from clickloom.functions import times

NO_CLICK = -999  # fixed value: "no category or product was clicked"


def clicked_id(column: Column) -> Column:
    return F.nullif(column, F.lit(NO_CLICK).cast("bigint"))


def id_list(text: Column) -> Column:
    """A comma list of ids as an array; a missing or blank list is null.

    Empty parts, as a trailing comma leaves, and parts that are no number are left out.
    """
    ids = F.transform(F.split(F.nullif(F.trim(text), F.lit("")), ","), lambda part: F.trim(part).try_cast("bigint"))
    return F.filter(ids, lambda i: i.isNotNull())


def ratio(part: Column, total: Column) -> Column:
    """``part / total`` to two decimals, null when there is nothing to divide by."""
    return F.round(part / F.nullif(total, F.lit(0).cast("bigint")), 2)


def as_text(df: DataFrame) -> DataFrame:
    """Dates, times and lists in the text form the result tables are published in."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DateType):
            column = times.format_date(column)
        elif isinstance(field.dataType, TimestampType):
            column = times.format_time(column)
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)
