"""The data contract of flight steps: marks, nine rules, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.predicates import after_or_unknown, all_present, within_or_unknown
from tarmaq.operators.lookup import Mark, mark_membership
from tarmaq.operators.quality import Rule, quarantine
from tarmaq.plans import vocabulary as V


def plausible(delay: str) -> Column:
    return within_or_unknown(F.col(delay), V.EARLIEST_DELAY_MIN, V.LATEST_DELAY_MIN)


def flight_rules() -> list[Rule]:
    """One list serves the counts, the filter and the reasons, so they cannot disagree."""
    conditions = [
        all_present(F.col("scheduled_departure"), F.col("scheduled_arrival")),
        F.col("flight_status").isin(V.COMPLETED, V.CANCELLED),
        after_or_unknown(F.col("scheduled_arrival"), F.col("scheduled_departure")),
        after_or_unknown(F.col("actual_arrival"), F.col("actual_departure")),
        plausible("departure_delay_min"),
        plausible("arrival_delay_min"),
        F.col("empresa_no_cadastro"),
        F.col("origem_no_cadastro"),
        F.col("destino_no_cadastro"),
    ]
    return [Rule(name, c) for name, c in zip(V.RULE_NAMES, conditions, strict=True)]


def marked(flights: DataFrame, airlines: DataFrame, aerodromes: DataFrame,
           unique: bool = False) -> DataFrame:
    """Flight steps with three registry-membership flags."""
    return mark_membership(flights, [
        Mark("origem_no_cadastro", "icao_origin", aerodromes, "icao", unique),
        Mark("destino_no_cadastro", "icao_destination", aerodromes, "icao", unique),
        Mark("empresa_no_cadastro", "icao_airline", airlines, "icao", unique),
    ])


def quarantined(marked_flights: DataFrame) -> DataFrame:
    """Flight steps that fail any rule, with the reasons."""
    failing = quarantine(marked_flights, flight_rules(), V.REASONS)
    return failing.withColumn(V.QUARANTINED_AT, F.current_timestamp())
