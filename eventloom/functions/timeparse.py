"""Event-time parsing and hour-partition columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted event times (fixed values): ``2024-01-31T23:59:59Z`` and
# ``2024-01-31 23:59:59``, optionally with a fraction, which is dropped.
EVENT_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?Z?$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_event_ts(text: Column) -> Column:
    """Text to timestamp at second grain; NULL for anything else.

    The shape test comes first because a bare cast also accepts partial dates
    and times of day.  The cast is Spark's exception-free parser, which matters
    when the two formats are mixed row by row.
    """
    return F.when(text.rlike(EVENT_TIME_SHAPE), F.substring(text, 1, 19).try_cast("timestamp"))


def hour_partition(ts: Column) -> dict[str, Column]:
    """Zero-padded partition values; one convention for every writer."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)
