"""Expressions over zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(time: Column) -> Column:
    """Seconds since 1970-01-01 of the wall-clock reading, whatever the session zone."""
    days = F.datediff(time, F.lit("1970-01-01").cast("date")).cast("bigint")
    clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return days * 86400 + clock.cast("bigint")


def whole_days_between(start: Column, end: Column) -> Column:
    """Complete 24-hour days from ``start`` to ``end`` (midnights are not counted)."""
    return F.timestamp_diff("DAY", start, end)
