"""Readable labels with explicit fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_fallback(label: Column, fallback: str, key: Column) -> Column:
    """The label, else ``fallback (key)``. A NULL key without label stays NULL."""
    return F.coalesce(label, F.concat(F.lit(f"{fallback} ("), key, F.lit(")")))


def pair_label(left: Column, right: Column) -> Column:
    """``left - right``; NULL if either side is."""
    return F.concat(left, F.lit(" - "), right)
