"""Questions answered from the one big table or the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.measures import percent_true, rows_where, sum_where
from tarmaq.plans import vocabulary as V

def _rows(name: str) -> Column:
    return F.count("*").alias(name)


def _completed(flights: DataFrame) -> DataFrame:
    return flights.where(F.col("flight_status") == V.COMPLETED)


def punctuality_by_airline(obt: DataFrame, judgeable_only: bool = False) -> DataFrame:
    """Delays and share of punctual departures per airline.

    The published share counts flights that cannot be judged as late; ``judgeable_only``
    leaves them out of the whole.
    """
    whole = F.count("departure_punctual") if judgeable_only else None
    return (
        _completed(obt).groupBy("airline_name")
        .agg(_rows("flights"),
             F.avg("departure_delay_min").alias("avg_dep_delay"),
             F.avg("arrival_delay_min").alias("avg_arr_delay"),
             percent_true(F.col("departure_punctual"), whole).alias("dep_on_time_pct"))
        .orderBy(F.desc("dep_on_time_pct"), "airline_name")
    )


def busiest_routes(obt: DataFrame, top: int = 10) -> DataFrame:
    return (
        _completed(obt).groupBy("route_municipalities")
        .agg(_rows("flights"), F.avg("minutes_recovered").alias("avg_minutes_recovered"))
        .orderBy(F.desc("flights"), "route_municipalities")
        .limit(top)
    )


def cancellations_by_airline(obt: DataFrame, top: int = 10) -> DataFrame:
    return (
        obt.groupBy("airline_name")
        .agg(_rows("flights"),
             F.sum(F.col("flight_cancelled").cast("int")).alias("cancelled"),
             percent_true(F.col("flight_cancelled")).alias("cancel_pct"))
        .orderBy(F.desc("cancelled"), "airline_name")
        .limit(top)
    )


def monthly_trend(obt: DataFrame) -> DataFrame:
    return (
        obt.groupBy("reference_month", "flight_status")
        .agg(_rows("flights"), F.avg("arrival_delay_min").alias("avg_delay"))
        .orderBy("reference_month", "flight_status")
    )


def hourly_cascade(obt: DataFrame) -> DataFrame:
    """How delays build up over the day."""
    return (
        _completed(obt).where(F.col("departure_delay_min").isNotNull())
        .groupBy("scheduled_departure_hour")
        .agg(F.avg("departure_delay_min").alias("avg_dep_delay"),
             F.avg("arrival_delay_min").alias("avg_arr_delay"),
             _rows("flights"))
        .orderBy("scheduled_departure_hour")
    )


def flights_by_status(obt: DataFrame) -> DataFrame:
    return obt.groupBy("flight_status").agg(_rows("flights"))


def late_departures_from(obt: DataFrame, city: str) -> DataFrame:
    """Airlines by late departures from airports whose municipality contains ``city``."""
    return (
        obt.where(F.col("origin_municipality").contains(city))
        .groupBy("airline_name")
        .agg(_rows("flights"),
             rows_where(~F.col("departure_punctual")).alias("late_departures"))
        .orderBy(F.desc("late_departures"), "airline_name")
    )


def cancellation_rate_by_route(obt: DataFrame) -> DataFrame:
    return (
        obt.groupBy("route_icao")
        .agg(_rows("flights"),
             rows_where(F.col("flight_cancelled")).alias("cancelled"),
             percent_true(F.col("flight_cancelled")).alias("cancel_pct"))
        .orderBy(F.desc("cancel_pct"), "route_icao")
    )


def recovery_by_month(obt: DataFrame) -> DataFrame:
    return (
        obt.groupBy("reference_month")
        .agg(F.avg("minutes_recovered").alias("avg_minutes_recovered"))
        .orderBy("reference_month")
    )


def foreign_cancellations(fact: DataFrame) -> DataFrame:
    """Cancelled flights per foreign airline; the registry is a column of the fact only."""
    return (
        fact.where((F.col("airline_registry") == "foreign") & F.col("flight_cancelled"))
        .groupBy("airline_name")
        .agg(_rows("cancelled"))
        .orderBy(F.desc("cancelled"), "airline_name")
    )


def worst_hour(obt: DataFrame) -> DataFrame:
    """The hour with the highest mean departure delay; the earlier hour wins a tie."""
    return (
        obt.where(F.col("departure_delay_min").isNotNull())
        .groupBy("scheduled_departure_hour")
        .agg(F.avg("departure_delay_min").alias("avg_dep_delay"), _rows("flights"))
        .orderBy(F.desc("avg_dep_delay"), "scheduled_departure_hour")
        .limit(1)
    )


def delay_recovery(obt: DataFrame) -> DataFrame:
    """Of the flights that won back minutes: how many still arrived late."""
    arrival = F.col("arrival_delay_min")
    return obt.where(F.col("minutes_recovered") > 0).agg(
        F.count("*").alias("recovered_some_minutes"),
        sum_where(arrival <= 0).alias("arrived_early_or_on_time"),
        sum_where(arrival > 0).alias("arrived_late_anyway"),
        sum_where(arrival > V.PUNCTUAL_WITHIN_MIN).alias("arrived_late_over_15"),
    )


def unjudgeable_by_status(obt: DataFrame) -> DataFrame:
    return obt.groupBy("flight_status").agg(
        _rows("flights"),
        rows_where(F.col("departure_punctual").isNull()).alias("departure_punctual_null"),
    )


def first_departures(flights: DataFrame, top: int = 5) -> DataFrame:
    """A spot check: the first flight steps by departure, in a total order."""
    shown = ["icao_airline", "flight_number", "icao_origin", "icao_destination",
             "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
             "departure_delay_min", "arrival_delay_min", "minutes_recovered", "flight_status"]
    return flights.select(*shown).orderBy(
        "scheduled_departure", *[c for c in shown if c != "scheduled_departure"]
    ).limit(top)


def registry_rows(registry: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """A spot check: the registry rows of named keys."""
    return registry.where(F.col(key).isin(wanted)).orderBy(key)
