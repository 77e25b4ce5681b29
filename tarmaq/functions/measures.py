"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows_where(condition: Column) -> Column:
    """Rows that meet a condition; 0 on empty input."""
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column) -> Column:
    """As ``rows_where``, but NULL on empty input, as a plain SUM gives."""
    return F.sum(F.when(condition, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double, NULL when the whole is 0."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def percent_true(flag: Column, of: Column | None = None) -> Column:
    """Share of true flags, of all rows unless another count is given."""
    return percent(F.sum(flag.cast("int")), F.count("*") if of is None else of)
