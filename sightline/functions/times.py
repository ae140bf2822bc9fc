"""Timestamp expressions. The session time zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline import constants as C


def parse_capture(text: Column) -> Column:
    """ISO-8601 first, then milliseconds with offset, then the plain form; else NULL."""
    dated = F.when(text.rlike(r"^\s*\d{4}"), text)
    return F.coalesce(
        F.try_to_timestamp(dated),
        F.try_to_timestamp(dated, F.lit(C.CAPTURE_OFFSET_FORMAT)),
        F.try_to_timestamp(dated, F.lit("yyyy-MM-dd HH:mm:ss")),
    )


def month_number(ts: Column) -> Column:
    """Month as the integer yyyyMM."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def timestamp_text(ts: Column) -> Column:
    """Timestamp as text with six fraction digits."""
    return F.date_format(ts, C.TIMESTAMP_TEXT_FORMAT)


def due_after_four_hours(ts: Column) -> Column:
    return ts + F.expr("interval 4 hours")


def previous_month_number(today: dt.date) -> int:
    """yyyyMM of the month before ``today``: the floor of recent partitions."""
    first = today.replace(day=1)
    last_month = first - dt.timedelta(days=1)
    return last_month.year * 100 + last_month.month
