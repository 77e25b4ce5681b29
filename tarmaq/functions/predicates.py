"""Predicates over nullable columns. 'Unknown' means a NULL side, which cannot be judged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_present(key: Column) -> Column:
    """Neither NULL nor empty. Never NULL itself."""
    return F.coalesce(key != "", F.lit(False))


def all_present(*values: Column) -> Column:
    return reduce(lambda a, b: a & b, [value.isNotNull() for value in values])


def after_or_unknown(later: Column, earlier: Column) -> Column:
    return F.coalesce(later > earlier, F.lit(True))


def within_or_unknown(value: Column, low: int, high: int) -> Column:
    return F.coalesce(value.between(low, high), F.lit(True))


def outside(value: Column, low: int, high: int) -> Column:
    """Known and out of range. Never NULL."""
    return ~within_or_unknown(value, low, high)


def at_most_when_judgeable(value: Column, limit: int, judgeable: Column) -> Column:
    """Three-valued: NULL where the row cannot be judged or the value is missing."""
    return F.when(judgeable, value <= limit)
