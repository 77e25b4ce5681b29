"""Text to typed values. Every cast is a trial: a bad value becomes NULL, never a lost row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FULL_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"


def named(column: str) -> Column:
    """A column whose name may hold dots, spaces, accents or brackets."""
    return F.col("`" + column.replace("`", "``") + "`")


def without_token(value: Column, token: str) -> Column:
    """NULL where the text is the token that stands for a missing value."""
    return F.nullif(value, F.lit(token))


def to_wall_clock(value: Column, strict: bool = False) -> Column:
    """Text to a timestamp without time zone.

    The lenient form takes whatever Spark's cast takes ('2025' is New Year's
    midnight); the strict form asks for a full date and a time of day.
    """
    if strict:
        value = F.when(value.rlike(_FULL_TIMESTAMP), value)
    return value.try_cast("timestamp_ntz")


def decimal_comma(value: Column) -> Column:
    """'12,5' to 12.5. Thousands separators are not guessed at: they give NULL."""
    return F.replace(value, F.lit(","), F.lit(".")).try_cast("double")
