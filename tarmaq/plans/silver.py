"""Typed mirrors of the raw tables. Row counts never change here."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.clock import minutes_between, time_of_day
from tarmaq.functions.typing import decimal_comma, named, to_wall_clock, without_token
from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import INGESTED_AT, SOURCE_FILE

MOMENTS = ["scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival"]
ROUTE_KEYS = ["icao_airline", "flight_number", "di_code", "line_type_code",
              "icao_origin", "icao_destination"]
DELAYS = ["departure_delay_min", "arrival_delay_min", "minutes_recovered"]
TYPED_AT = "_transformed_at"


def with_parts(df: DataFrame) -> DataFrame:
    """Add the date and the time of day of each moment."""
    parts = {}
    for moment in MOMENTS:
        parts[f"{moment}_date"] = F.col(moment).cast("date")
        parts[f"{moment}_time"] = time_of_day(F.col(moment))
    return df.withColumns(parts)


def with_delays(df: DataFrame) -> DataFrame:
    """Add departure delay, arrival delay and the minutes won back between them."""
    delayed = df.withColumns({
        f"{end}_delay_min": minutes_between(F.col(f"scheduled_{end}"), F.col(f"actual_{end}"))
        for end in ("departure", "arrival")
    })
    won_back = F.col("departure_delay_min") - F.col("arrival_delay_min")
    return delayed.withColumn("minutes_recovered", won_back)


def flights(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Flight steps with typed moments, split dates and times, and delay minutes."""
    text = bronze.select(
        *[named(source).alias(target) for source, target in V.FLIGHT_COLUMNS.items()],
        SOURCE_FILE, INGESTED_AT,
    )
    typed = text.withColumns({
        m: to_wall_clock(without_token(F.col(m), V.MISSING_MOMENT), strict) for m in MOMENTS
    } | {
        "justification_code": without_token(F.col("justification_code"), V.MISSING_JUSTIFICATION)
    })
    split_moments = [f"{m}{part}" for m in MOMENTS for part in ("", "_date", "_time")]
    return with_delays(with_parts(typed)).select(
        *ROUTE_KEYS, *split_moments, "flight_status", "justification_code", *DELAYS,
        SOURCE_FILE, INGESTED_AT, F.current_timestamp().alias(TYPED_AT),
    )


def airlines(registries: Mapping[str, DataFrame]) -> DataFrame:
    """All company registries in one table, each row labelled with the registry it is from."""
    labelled = [
        registry.select("icao", "iata_code", "legal_name", "service", "city", "state", "status",
                        F.lit(label).alias("registry_origin"), SOURCE_FILE, INGESTED_AT)
        for label, registry in registries.items()
    ]
    return reduce(DataFrame.unionByName, labelled).withColumn(TYPED_AT, F.current_timestamp())


def aerodromes(bronze: DataFrame) -> DataFrame:
    """Aerodromes with a numeric altitude."""
    return bronze.select(
        "icao", "ciad", "name", "municipality",
        F.col("state").alias("state_name"),
        "served_municipality",
        F.col("served_state").alias("served_state_name"),
        F.col("latitude").alias("latitude_dms"),
        F.col("longitude").alias("longitude_dms"),
        decimal_comma(F.col("altitude")).alias("altitude_m"),
        "status", INGESTED_AT, F.current_timestamp().alias(TYPED_AT),
    )


def operation_codes(bronze: DataFrame) -> DataFrame:
    return bronze.select("domain", "code", "description", F.current_timestamp().alias(TYPED_AT))
