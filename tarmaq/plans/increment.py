"""The fact by months: arrivals add what is new, a corrected month is rebuilt alone.

Both give the rows of a full refresh, as long as the registries are the same. An arrival costs a
scan of its own rows and of the keys in the months it touches, not of the whole history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.clock import month_start
from tarmaq.operators.dedup import distinct_rows
from tarmaq.plans import gold
from tarmaq.sources.months import append_parts, in_parts, part_values, read_parts, replace_parts

MONTH = "reference_month"
_NEW = "__new"


def month_of(flights: DataFrame) -> DataFrame:
    """Typed flights with the month that the fact will give them."""
    return flights.withColumn(MONTH, month_start(F.col("scheduled_departure").cast("date")))


def new_steps(arrived: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct step keys of ``arrived`` that ``known`` does not hold; NULL equals NULL.

    Copies and known steps are told in one group, so each side is shuffled once. The month follows
    from the keys: ``known`` should be read from the months that ``arrived`` touches.
    """
    sides = [df.select(*gold.STEP_KEYS, F.lit(new).alias(_NEW))
             for df, new in ((arrived, True), (known, False))]
    dealt = sides[0].unionByName(sides[1]).repartition(*gold.STEP_KEYS)
    told = dealt.groupBy(*gold.STEP_KEYS).agg(F.bool_and(_NEW).alias(_NEW))
    return told.where(_NEW).drop(_NEW)


def write_steps(steps: DataFrame, path: str, airlines: DataFrame, codes: DataFrame,
                write: Callable[..., None],
                kept: Callable[[DataFrame], DataFrame] = lambda fact: fact) -> None:
    """Write the fact of distinct step keys by month, only the keys being shuffled for it.

    ``write`` adds or replaces months; ``kept`` may leave out rows of the fact.
    """
    write(month_of(steps), path, MONTH,
          lambda dealt: kept(gold.fact_of_steps(dealt.drop(MONTH), airlines, codes)))


def add_arrivals(arrived: DataFrame, path: str, airlines: DataFrame, codes: DataFrame) -> list:
    """Add the flight steps of a load that the fact at ``path`` does not hold yet.

    Returns the months that the load touches. Repeating a load adds nothing: a load that failed is
    run again as it was. ``arrived`` is used twice, so pass a table.
    """
    months = part_values(month_of(arrived), MONTH)
    like = gold.fact_flights(arrived, airlines, codes)
    known = read_parts(arrived.sparkSession, path, like).where(in_parts(MONTH, months))
    fresh = new_steps(arrived, known.select(*gold.STEP_KEYS))
    write_steps(fresh, path, airlines, codes, append_parts)
    return months


def rebuild_months(flights: DataFrame, months: list, path: str, airlines: DataFrame,
                   codes: DataFrame) -> None:
    """Build the fact of some months anew from the typed flights, and replace only those months."""
    chosen = month_of(flights).where(in_parts(MONTH, months)).drop(MONTH)
    write_steps(distinct_rows(chosen, gold.STEP_KEYS), path, airlines, codes, replace_parts)
