"""Star schema and one big table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.clock import month_start, weekday_name
from tarmaq.functions.labels import or_fallback, pair_label
from tarmaq.functions.predicates import at_most_when_judgeable, outside
from tarmaq.operators.audit import distinct_values
from tarmaq.operators.dedup import distinct_rows, first_per_key
from tarmaq.operators.lookup import attach, best_per_key
from tarmaq.operators.quality import masked
from tarmaq.plans import vocabulary as V
from tarmaq.plans.silver import DELAYS, MOMENTS, ROUTE_KEYS, with_delays, with_parts
from tarmaq.sources.delimited import INGESTED_AT, SOURCE_FILE

STEP_KEYS = [*ROUTE_KEYS, *MOMENTS, "flight_status"]
PROCESSED_AT = "_processed_at"


def deduplicated(flights: DataFrame) -> DataFrame:
    """One whole row per flight step: the earliest load wins, then the file name."""
    return first_per_key(flights, STEP_KEYS, [INGESTED_AT, SOURCE_FILE])


def best_airlines(airlines: DataFrame) -> DataFrame:
    """One company per code: active ones first, then by name."""
    inactive = F.when(F.col("status") == V.ACTIVE, 0).otherwise(1)
    return best_per_key(airlines, "icao", [inactive, "legal_name", "registry_origin"],
                        ["legal_name", "registry_origin"])


def first_aerodromes(aerodromes: DataFrame) -> DataFrame:
    """One aerodrome per code: the first by name."""
    return best_per_key(aerodromes, "icao", ["name", "municipality", "state_name"],
                        ["name", "municipality", "state_name"])


def airport_codes(flights: DataFrame) -> DataFrame:
    """Every code seen as an origin or a destination."""
    return distinct_values(flights, ["icao_origin", "icao_destination"], "icao_airport")


def dim_airport(flights: DataFrame, aerodromes: DataFrame) -> DataFrame:
    """One row per airport that flights use, registered or not."""
    registry = first_aerodromes(aerodromes).withColumn("registered", F.lit(True))
    code = F.col("icao_airport")
    described = attach(airport_codes(flights), "icao_airport", registry, "icao", {
        "name": "registered_name",
        "municipality": "airport_municipality",
        "state_name": "airport_state",
        "registered": "registered",
    })
    return described.select(
        "icao_airport",
        or_fallback(F.col("registered_name"), V.UNKNOWN_AIRPORT, code).alias("airport_name"),
        "airport_municipality",
        "airport_state",
        F.when(code.rlike(V.HOME_PREFIX), V.HOME_COUNTRY).otherwise(V.ABROAD)
        .alias("airport_country"),
        F.col("registered").isNotNull().alias("in_anac_registry"),
        F.current_timestamp().alias(PROCESSED_AT),
    )


def with_code_descriptions(flights: DataFrame, codes: DataFrame,
                           domains: dict[str, str]) -> DataFrame:
    """Describe code columns; each looks only at the codes of its own domain."""
    for domain, description in domains.items():
        catalogue = codes.where(F.col("domain") == domain)
        flights = attach(flights, domain, catalogue, "code", {"description": description})
        label = or_fallback(F.col(description), V.UNKNOWN_CODE, F.col(domain))
        flights = flights.withColumn(description, label)
    return flights


def flight_scope(line_type: Column) -> Column:
    return (
        F.when(line_type.isin(V.DOMESTIC_LINES), V.DOMESTIC)
        .when(line_type.isin(V.INTERNATIONAL_LINES), V.INTERNATIONAL)
        .otherwise(V.UNCLASSIFIED)
    )


def out_of_range() -> Column:
    """Either delay is known and implausible. Never NULL."""
    bounds = (V.EARLIEST_DELAY_MIN, V.LATEST_DELAY_MIN)
    return outside(F.col("departure_delay_min"), *bounds) | outside(
        F.col("arrival_delay_min"), *bounds)


def plausible_only(flights: DataFrame) -> DataFrame:
    """Flag implausible delays and blank all three metrics of such rows."""
    flagged = flights.withColumn("delay_out_of_range", out_of_range())
    return masked(flagged, DELAYS, F.col("delay_out_of_range"))


def punctual(delay: str) -> Column:
    return at_most_when_judgeable(
        F.col(delay), V.PUNCTUAL_WITHIN_MIN, ~F.col("delay_out_of_range"))


def fact_flights(flights: DataFrame, airlines: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per flight step with the business rules applied.

    Everything the fact shows follows from the step keys, so only those are shuffled, for a
    hash aggregate that folds copies; dates and delays are derived again after.
    """
    return fact_of_steps(distinct_rows(flights, STEP_KEYS), airlines, codes)


def fact_of_steps(keys: DataFrame, airlines: DataFrame, codes: DataFrame) -> DataFrame:
    """:func:`fact_flights` from step keys that are distinct already. No shuffle of them."""
    steps = plausible_only(with_delays(with_parts(keys)))
    resolved = attach(steps, "icao_airline", best_airlines(airlines), "icao", {
        "legal_name": "legal_name", "registry_origin": "airline_registry",
    })
    described = with_code_descriptions(resolved, codes, {
        "di_code": "di_description", "line_type_code": "line_type_description",
    })
    departure_day = F.col("scheduled_departure_date")
    return described.select(
        "icao_airline",
        or_fallback(F.col("legal_name"), V.UNKNOWN_AIRLINE, F.col("icao_airline"))
        .alias("airline_name"),
        "airline_registry",
        "flight_number",
        "di_code", "di_description",
        "line_type_code", "line_type_description",
        flight_scope(F.col("line_type_code")).alias("flight_scope"),
        "icao_origin", "icao_destination",
        pair_label(F.col("icao_origin"), F.col("icao_destination")).alias("route"),
        "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
        F.hour("scheduled_departure").alias("scheduled_departure_hour"),
        weekday_name(departure_day, V.WEEKDAYS).alias("day_of_week"),
        month_start(departure_day).alias("reference_month"),
        "actual_departure", "scheduled_arrival", "actual_arrival",
        *DELAYS,
        "delay_out_of_range",
        punctual("departure_delay_min").alias("departure_punctual"),
        punctual("arrival_delay_min").alias("arrival_punctual"),
        "flight_status",
        (F.col("flight_status") == V.CANCELLED).alias("flight_cancelled"),
        (F.col("flight_status") == V.COMPLETED).alias("flight_completed"),
        F.current_timestamp().alias(PROCESSED_AT),
    )


def obt_flights(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """The fact with its airports described in both roles. Row count = fact.

    Pass the airports as a written table, whose size Catalyst knows.
    """
    roles = {"origin": "icao_origin", "destination": "icao_destination"}
    traits = {"airport_name": "airport_name", "airport_municipality": "municipality",
              "airport_state": "state", "airport_country": "country"}
    wide = fact
    for role, code in roles.items():
        wide = attach(wide, code, airports, "icao_airport",
                      {trait: f"{role}_{short}" for trait, short in traits.items()})
    origin, destination = (
        F.coalesce(F.col(f"{role}_municipality"), F.col(code)) for role, code in roles.items()
    )
    airport_columns = {
        code: [code, *[f"{role}_{short}" for short in traits.values()]]
        for role, code in roles.items()
    }
    return wide.select(
        "icao_airline", "airline_name", "flight_number",
        "di_code", "di_description", "line_type_code", "line_type_description", "flight_scope",
        *airport_columns["icao_origin"],
        *airport_columns["icao_destination"],
        F.col("route").alias("route_icao"),
        pair_label(origin, destination).alias("route_municipalities"),
        "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
        "scheduled_departure_hour", "day_of_week", "reference_month",
        "actual_departure", "scheduled_arrival", "actual_arrival",
        *DELAYS, "delay_out_of_range", "departure_punctual", "arrival_punctual",
        "flight_status", "flight_completed", "flight_cancelled",
        PROCESSED_AT,
    )
