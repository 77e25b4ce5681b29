"""What each column means, and the tags of each table: the source of truth for both.

The texts are the columns' comments in the catalog, which each write sets anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmaq.plans import vocabulary as V

_MOMENT_TEXT = {
    "scheduled_departure": "planned departure, local time of the origin",
    "actual_departure": "departure as flown, local time of the origin; NULL if cancelled",
    "scheduled_arrival": "planned arrival, local time of the destination",
    "actual_arrival": "arrival as flown, local time of the destination; NULL if cancelled",
}

_AIRPORT_TEXT = {
    "airport_name": "name in the registry, or a text that it is not registered",
    "municipality": "municipality in the registry",
    "state": "state in the registry",
    "country": "home country or abroad, by the code prefix",
}

MEANINGS = {
    "icao_airline": "three-letter code of the operating airline",
    "airline_name": "legal name, or a text that the airline is not registered",
    "airline_registry": "registry the name comes from: national or foreign",
    "flight_number": "commercial flight number as text; leading zeros count",
    "di_code": "authorisation code of the flight step",
    "di_description": "meaning of the authorisation code",
    "line_type_code": "N and C domestic, I and G international",
    "line_type_description": "meaning of the line type",
    "flight_scope": "domestic, international or unclassified, by line type",
    "icao_origin": "code of the departure airport",
    "icao_destination": "code of the arrival airport",
    "route": "origin and destination codes",
    "route_icao": "origin and destination codes",
    "route_municipalities": "origin and destination municipalities, codes where unknown",
    "scheduled_departure_hour": "hour of the planned departure, 0 to 23",
    "day_of_week": "weekday of the planned departure",
    "reference_month": "first day of the month of the planned departure",
    "flight_status": "status reported by the airline",
    "justification_code": "stated reason of a delay",
    "departure_delay_min": "minutes late at departure, negative if early",
    "arrival_delay_min": "minutes late at arrival, negative if early",
    "minutes_recovered": "departure delay less arrival delay",
    "delay_out_of_range": "a delay lies outside -120 to 1440 minutes, so all three are NULL",
    "departure_punctual": "left at most 15 minutes late; NULL if it cannot be judged",
    "arrival_punctual": "arrived at most 15 minutes late; NULL if it cannot be judged",
    "flight_cancelled": "status is cancelled",
    "flight_completed": "status is completed",
    "icao": "code of the airline or aerodrome; may be empty",
    "icao_airport": "airport code",
    "in_anac_registry": "the airport is registered",
    "airport_municipality": _AIRPORT_TEXT["municipality"],
    "airport_state": _AIRPORT_TEXT["state"],
    "airport_country": _AIRPORT_TEXT["country"],
    "airport_name": _AIRPORT_TEXT["airport_name"],
    "iata_code": "two-letter code",
    "legal_name": "legal name of the company",
    "service": "kind of service",
    "city": "city of the company",
    "state": "state of the company or aerodrome",
    "status": "registry status",
    "registry_origin": "registry the row comes from: national or foreign",
    "ciad": "national aerodrome code",
    "name": "name of the aerodrome",
    "municipality": "municipality of the aerodrome",
    "state_name": "state of the aerodrome",
    "served_municipality": "municipality the aerodrome serves",
    "served_state": "state the aerodrome serves",
    "served_state_name": "state the aerodrome serves",
    "latitude": "latitude as published",
    "longitude": "longitude as published",
    "latitude_dms": "latitude in degrees, minutes and seconds",
    "longitude_dms": "longitude in degrees, minutes and seconds",
    "altitude": "altitude with a decimal comma",
    "altitude_m": "altitude in metres",
    "domain": "which code column the code belongs to",
    "code": "operation code",
    "description": "meaning of the operation code",
    "origem_no_cadastro": "the origin is registered",
    "destino_no_cadastro": "the destination is registered",
    "empresa_no_cadastro": "the airline is registered",
    V.REASONS: "names of the failed rules, in rule order",
    "_arquivo_origem": "file the row came from",
    "_ingerido_em": "when the row was loaded",
    "_transformed_at": "when the row was typed",
    V.QUARANTINED_AT: "when the row was quarantined",
    "_processed_at": "when the row was built",
}
for _moment, _text in _MOMENT_TEXT.items():
    MEANINGS[_moment] = _text
    MEANINGS[f"{_moment}_date"] = f"date of {_text}"
    MEANINGS[f"{_moment}_time"] = f"time of day of {_text}"
for _role in ("origin", "destination"):
    for _trait, _text in _AIRPORT_TEXT.items():
        MEANINGS[f"{_role}_{_trait}"] = f"{_role}: {_text}"
for _source, _target in V.FLIGHT_COLUMNS.items():
    MEANINGS[_source] = f"as published: {MEANINGS[_target]}"

TABLES = [
    "bronze.vra", "bronze.aerodromos", "bronze.national_airlines", "bronze.foreign_airlines",
    "bronze.operation_codes", "silver.vra", "silver.airlines", "silver.aerodromes",
    "silver.operation_codes", "silver.vra_quarentena", "gold.dim_airport", "gold.fact_flights",
    "gold.obt_flights",
]
_PATTERNS = {"dim": "dimension", "fact": "fact", "obt": "wide table"}


def _tags_of(table: str) -> dict[str, str]:
    """What a table's name says: its layer, how it is built, and what one row is."""
    layer, _, name = table.partition(".")
    built = {"bronze": "raw text", "silver": "typed"}.get(layer) or _PATTERNS[name.split("_")[0]]
    if name.endswith("_quarentena"):
        built = "quarantine"
    step = name.startswith(("vra", "fact", "obt"))
    row = "flight step" if step else "airport" if name == "dim_airport" else "registry entry"
    return {"layer": layer, "pattern": built, "grain": row}


TAGS = {table: _tags_of(table) for table in TABLES}


def meanings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MEANINGS.items()), "column_name string, meaning string")


def tags(spark: SparkSession) -> DataFrame:
    listed = [
        (*table.split("."), name, value)
        for table, pairs in TAGS.items() for name, value in pairs.items()
    ]
    return spark.createDataFrame(
        listed, "layer string, table_name string, tag_name string, tag_value string")
