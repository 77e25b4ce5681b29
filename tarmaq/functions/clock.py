"""Dates and times of day, independent of the session time zone for NTZ input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, truncated toward zero.

    Works on the interval itself: converting wall-clock values to instants first
    would move times that a daylight-saving change skips.
    """
    return (end - start).cast("interval minute").cast("bigint").try_cast("int")


def time_of_day(moment: Column) -> Column:
    """'HH:mm' text.

    Two lookups in a constant array cost a third of formatting the timestamp, and unlike
    ``date_format`` they never pass through the session time zone. ``get`` keeps a NULL index
    NULL, where ``element_at`` in ANSI mode is planned as if it could not be.
    """
    two_digits = F.array(*[F.lit(f"{number:02d}") for number in range(60)])
    hour, minute = (F.get(two_digits, part) for part in (F.hour(moment), F.minute(moment)))
    return F.concat(hour, F.lit(":"), minute)


def weekday_name(day: Column, sunday_first: Sequence[str]) -> Column:
    """The name of the weekday, from seven names that start on Sunday."""
    return F.get(F.array(*[F.lit(name) for name in sunday_first]), F.dayofweek(day) - 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
