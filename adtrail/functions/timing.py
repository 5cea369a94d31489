"""Event time derived from the raw timestamp text."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(raw: str = "timestamp") -> Column:
    """The raw text as a TIMESTAMP, NULL where it does not parse."""
    return F.try_to_timestamp(F.col(raw))


def event_date(column: str = "event_time") -> Column:
    return F.to_date(F.col(column))


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval(span: timedelta) -> Column:
    """A day-time interval literal."""
    return F.lit(span)


def as_delay(span: timedelta) -> str:
    """The text form ``withWatermark`` takes."""
    return f"{micros(span) // 1000} milliseconds"
