"""Durations, reference moments and conversions between text and time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(duration: str) -> int:
    """Whole seconds in a duration such as ``"5 minutes"``."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def label(duration: str) -> str:
    """Column suffix of a window length: ``"5 minutes"`` gives ``"5m"``."""
    amount, unit = duration.split()
    return f"{int(amount)}{unit[0].lower()}"


def interval(duration: str) -> Column:
    """A duration as an interval literal."""
    return F.expr(f"INTERVAL {seconds(duration)} SECONDS")


def time_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def moment(as_of, like: T.DataType) -> Column:
    """A reference time in the type of the column it is compared with.

    Casting the literal instead of the column keeps the comparison pushable to the
    scan. ``None`` means the start of the batch or micro-batch.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, (dt.datetime, dt.date)):
        as_of = F.lit(as_of.isoformat())
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return as_of.cast(like)


def newest(df: DataFrame, column: str = "event_time") -> Column:
    """The largest value of a column as a scalar subquery, usable as ``as_of``."""
    return df.agg(F.max(column)).scalar()


def bucket_start(column: str | Column, duration: str) -> Column:
    """Start of the tumbling window a time falls into."""
    return F.window(column, duration).getField("start")


def parse_iso(column: str | Column) -> Column:
    """ISO text to timestamp; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(column)


def to_iso(column: str | Column) -> Column:
    """Timestamp to zone-less ISO text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def whole_minutes(earlier: Column, later: Column) -> Column:
    """Complete minutes between two times, days included."""
    return F.timestamp_diff("MINUTE", earlier, later)
