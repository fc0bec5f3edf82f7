"""Time columns: parsing, formatting and differences. All of them read the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the text tables and keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def parse_time(text: Column) -> Column:
    """Null where the text is no time: one bad line must not end a scan of the whole log."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def format_time(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)


def format_date(time: Column) -> Column:
    return F.date_format(time, DATE_FORMAT)


def date_key(time: Column) -> Column:
    return F.date_format(time, DATE_KEY_FORMAT)


def minute_key(time: Column) -> Column:
    return F.date_format(time, MINUTE_KEY_FORMAT)


def parse_date_key(key: Column) -> Column:
    return F.to_date(key, DATE_KEY_FORMAT)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def hour_text(time: Column) -> Column:
    """Hour of the day with its leading zero."""
    return F.date_format(time, "HH")


def minute_text(time: Column) -> Column:
    """Minute of the hour with its leading zero."""
    return F.date_format(time, "mm")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
