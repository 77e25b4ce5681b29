from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmaq.plans import consumption, gold, silver
from tarmaq.plans import vocabulary as V
from tarmaq.plans.bronze import operation_codes
from tests.conftest import plan, rows

KEYS = list(V.FLIGHT_COLUMNS)
SOURCE = ", ".join(f"`{key}` string" for key in KEYS) + ", _arquivo_origem string"


def raw(spark, *steps):
    """Raw steps from overrides of one plain flight."""
    plain = dict(zip(KEYS, [
        "AZU", "0042", "0", "N", "SBGR", "SBSP", "2025-08-01 10:00:00", "2025-08-01 10:05:30",
        "2025-08-01 11:00:00", "2025-08-01 11:01:00", "REALIZADO", "N/A"]))
    plain["_arquivo_origem"] = "a.csv"
    table = [tuple((plain | step).values()) for step in steps]
    return spark.createDataFrame(table, SOURCE).withColumn("_ingerido_em", F.current_timestamp())


@pytest.fixture
def airlines(spark):
    return spark.createDataFrame([
        ("AZU", "Zeta Old", "INATIVA", "national"), ("AZU", "Azul", "ATIVA", "national"),
        ("AZU", "Azul", "ATIVA", "foreign"), ("", "Nameless", "ATIVA", "national"),
    ], "icao string, legal_name string, status string, registry_origin string")


@pytest.fixture
def aerodromes(spark):
    return spark.createDataFrame([
        ("SBGR", "Guarulhos", "Guarulhos", "SP"), ("SBSP", "Congonhas", None, "SP"),
        ("SBSP", "Zz", "Nowhere", "RJ"), (None, "No code", "X", "Y"),
    ], "icao string, name string, municipality string, state_name string")


def fact_of(spark, airlines, *steps):
    flights = silver.flights(raw(spark, *steps))
    return gold.fact_flights(flights, airlines, operation_codes(spark))


def test_mirror_types_without_losing_rows(spark):
    flights = silver.flights(raw(
        spark, {}, {"Partida Real": "null", "Chegada Real": "garbage"}, {"Partida Prevista": "null"}))
    assert len(flights.columns) == 26
    found = rows(flights.select("departure_delay_min", "arrival_delay_min", "minutes_recovered",
                                "scheduled_departure_time", "flight_number", "justification_code"))
    assert found == sorted([
        (5, 1, 4, "10:00", "0042", None), (None, None, None, "10:00", "0042", None),
        (None, 1, None, None, "0042", None)], key=repr)


def test_fact_rules(spark, airlines):
    columns = ["airline_name", "airline_registry", "di_description", "line_type_description",
               "flight_scope", "departure_delay_min", "delay_out_of_range", "departure_punctual",
               "flight_cancelled", "day_of_week", "route"]
    fact = fact_of(
        spark, airlines,
        {}, {},  # an exact copy
        {"Número Voo": "1", "Partida Real": "2025-08-01 10:15:59"},
        {"Número Voo": "2", "Partida Real": "2025-08-01 10:16:00"},
        {"Número Voo": "3", "Partida Real": "2025-08-03 10:16:00"},
        {"Número Voo": "4", "Partida Real": "null", "Chegada Real": "null",
         "Situação Voo": "CANCELADO", "ICAO Empresa Aérea": "XXX", "Código Tipo Linha": "X",
         "Código Autorização (DI)": "1"},
        {"Número Voo": "5", "ICAO Empresa Aérea": None, "Situação Voo": None,
         "Código Autorização (DI)": None, "Partida Prevista": "null"},
    )
    assert len(fact.columns) == 31
    known = ("Azul", "foreign", "Etapa Regular", "Doméstica Mista", "Domestico")
    assert {row["flight_number"]: tuple(row[c] for c in columns) for row in fact.collect()} == {
        "0042": (*known, 5, False, True, False, "sexta", "SBGR - SBSP"),
        "1": (*known, 15, False, True, False, "sexta", "SBGR - SBSP"),
        "2": (*known, 16, False, False, False, "sexta", "SBGR - SBSP"),
        "3": (*known, None, True, None, False, "sexta", "SBGR - SBSP"),
        "4": ("COMPANHIA NAO CADASTRADA (XXX)", None, "Codigo nao catalogado (1)",
              "Codigo nao catalogado (X)", "Nao classificado", None, False, None, True, "sexta",
              "SBGR - SBSP"),
        "5": (None, None, None, "Doméstica Mista", "Domestico", None, False, None, None, None,
              "SBGR - SBSP"),
    }
    assert fact.count() == 6


def test_airports_and_one_big_table(spark, airlines, aerodromes):
    steps = [{}, {"ICAO Aeródromo Destino": "KJFK"}, {"ICAO Aeródromo Origem": ""},
             {"ICAO Aeródromo Origem": None, "ICAO Aeródromo Destino": "SNXX"}]
    flights = silver.flights(raw(spark, *steps))
    airports = gold.dim_airport(flights, aerodromes)
    unknown = V.UNKNOWN_AIRPORT
    assert rows(airports.drop("_processed_at")) == sorted([
        ("SBGR", "Guarulhos", "Guarulhos", "SP", "Brasil", True),
        ("SBSP", "Congonhas", None, "SP", "Brasil", True),
        ("KJFK", f"{unknown} (KJFK)", None, None, "Exterior", False),
        ("SNXX", f"{unknown} (SNXX)", None, None, "Brasil", False)], key=repr)
    fact = fact_of(spark, airlines, *steps)
    obt = gold.obt_flights(fact, airports)
    assert len(obt.columns) == 39 and obt.count() == fact.count() == 4
    assert rows(obt.select("route_municipalities", "origin_country")) == sorted([
        ("Guarulhos - SBSP", "Brasil"), ("Guarulhos - KJFK", "Brasil"), (" - SBSP", None),
        (None, None)], key=repr)


def test_dedup_keeps_the_earliest_load_then_file(spark):
    flights = silver.flights(raw(spark, {"_arquivo_origem": "b.csv"}, {}, {"Partida Real": "null"},
                                 {"Partida Real": "null", "_arquivo_origem": "0.csv"}))
    early = flights.withColumn("_ingerido_em", F.when(
        F.col("_arquivo_origem") == "b.csv", F.lit(datetime(2020, 1, 1))
    ).otherwise(F.lit(datetime(2021, 1, 1))))
    kept = gold.deduplicated(early.drop("_transformed_at"))
    assert rows(kept.select("_arquivo_origem")) == [("0.csv",), ("b.csv",)]
    assert rows(gold.deduplicated(kept)) == rows(kept)


def test_layers_keep_their_counts(flights):
    silver_rows = flights.silver.count()
    assert flights.bronze.count() == silver_rows == flights.marked.count()
    keys = flights.silver.select(*gold.STEP_KEYS).distinct().count()
    assert flights.fact.count() == flights.obt.count() == keys < silver_rows
    assert flights.airports.count() == flights.airports.select("icao_airport").distinct().count()


def test_rebuilding_gives_the_same_rows(flights):
    once = flights.derived_fact().drop("_processed_at")
    again = flights.derived_fact().drop("_processed_at")
    assert once.exceptAll(again).count() == 0 == again.exceptAll(once).count()


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_big_sides_give_the_same_table_without_broadcast(spark, flights, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        obt = flights.derived_obt().drop("_processed_at")
        assert ("SortMergeJoin" in plan(obt)) == (limit == "-1")
        assert obt.exceptAll(flights.obt.drop("_processed_at")).count() == 0
        assert obt.count() == flights.fact.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_consumption_reads_only_what_it_needs(flights):
    text = plan(consumption.hourly_cascade(flights.obt))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(flight_status,REALIZADO)" in pushed
    assert "IsNotNull(departure_delay_min)" in pushed
    assert "ReadSchema: struct<scheduled_departure_hour:int,departure_delay_min:int," in text
    assert "airline_name" not in text


def test_fact_shuffles_only_the_step_keys_once(flights):
    text = plan(flights.derived_fact())
    shuffled = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    registry = [x for x in shuffled if "hashpartitioning(icao#" in x]
    assert len(shuffled) - len(registry) == 1 and len(registry) == 1
    assert "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") == 3


def test_mirror_and_marks_need_no_shuffle(flights):
    assert "Exchange" not in plan(flights.derived_silver())
    assert "Exchange hashpartitioning" not in plan(flights.marked)


def test_first_departures_are_in_a_total_order(flights):
    first = consumption.first_departures(flights.silver).collect()
    assert len(first) == 5 and first == consumption.first_departures(flights.silver).collect()
