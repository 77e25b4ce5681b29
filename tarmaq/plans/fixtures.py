"""Flight-shaped inputs derived from the benchmark tables by pure expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.operators.dedup import distinct_rows
from tarmaq.plans import bronze, contract, gold, silver
from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import INGESTED_AT, SOURCE_FILE
from tarmaq.sources.shared import fingerprint, stored_once


def _minutes(amount: Column) -> Column:
    return F.lit(timedelta(minutes=1)) * amount


def _airport(key: str) -> Column:
    letter = F.substring(F.lit("BDXK"), (F.col(key) % 4 + 1).cast("int"), F.lit(1))
    return F.concat(F.lit("S"), letter, F.lpad((F.col(key) % 30).cast("string"), 2, "0"))


def _airline(key: str, codes: int) -> Column:
    return F.concat(F.lit("A"), F.lpad((F.col(key) % codes).cast("string"), 3, "0"))


def _text(moment: str) -> Column:
    return F.coalesce(F.col(moment).cast("string"), F.lit(V.MISSING_MOMENT))


def typed_steps(lineitem: DataFrame) -> DataFrame:
    """Flight steps in typed form, one per line item, with every kind of defect."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    base = lineitem.withColumns({
        "sd": F.when(order % 33 != 0, F.col("l_shipdate") + _minutes(order % 1440)),
        "dur": F.col("l_linenumber") * 35 + 30,
        "dd": part % 180 - 60 + F.when(part % 101 == 0, 2000)
        .when(part % 103 == 0, -300).otherwise(0),
        "rec": supplier % 41 - 20,
        "cancelled": (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1),
    })
    start = F.coalesce("sd", "l_shipdate")
    flown = ~F.col("cancelled")
    return base.select(
        "l_orderkey",
        _airline("l_suppkey", 120).alias("icao_airline"),
        order.cast("string").alias("flight_number"),
        (supplier % 11).cast("string").alias("di_code"),
        F.substring(F.lit("NCIGX"), (part % 5 + 1).cast("int"), F.lit(1)).alias("line_type_code"),
        _airport("l_partkey").alias("icao_origin"),
        _airport("l_orderkey").alias("icao_destination"),
        F.col("sd").alias("scheduled_departure"),
        F.when(flown, start + _minutes(F.col("dd"))).alias("actual_departure"),
        F.when(order % 37 == 0, F.col("sd") - _minutes(F.lit(10)))
        .otherwise(F.col("sd") + _minutes(F.col("dur"))).alias("scheduled_arrival"),
        F.when(flown & (order % 53 == 0), start + _minutes(F.col("dd") - 5))
        .when(flown, start + _minutes(F.col("dur") + F.col("dd") - F.col("rec")))
        .alias("actual_arrival"),
        F.when(order % 211 == 0, "DESCONHECIDO")
        .when(order % 223 == 0, F.lit(None))
        .when(F.col("cancelled"), V.CANCELLED)
        .otherwise(V.COMPLETED).alias("flight_status"),
    )


def raw_steps(lineitem: DataFrame) -> DataFrame:
    """The same steps as they would arrive: text under source headers, some delivered twice."""
    steps = typed_steps(lineitem)
    text = {
        name: _text(name) if name in silver.MOMENTS else F.col(name)
        for name in V.FLIGHT_COLUMNS.values() if name != "justification_code"
    }
    reason = F.concat(F.lit("J"), (F.col("l_orderkey") % 9).cast("string"))
    text["justification_code"] = F.when(F.col("l_orderkey") % 7 == 0, reason).otherwise(
        V.MISSING_JUSTIFICATION)
    month = F.concat(F.lit("VRA_"), (F.col("l_orderkey") % 12).cast("string"), F.lit(".csv"))
    files = F.when(F.col("l_orderkey") % 500 == 0, F.array(month, F.lit("VRA_dup.csv")))
    delivered = steps.withColumn(SOURCE_FILE, F.explode(F.coalesce(files, F.array(month))))
    return delivered.select(
        *[text[target].alias(source) for source, target in V.FLIGHT_COLUMNS.items()],
        SOURCE_FILE, F.current_timestamp().alias(INGESTED_AT),
    )


def raw_companies(supplier: DataFrame, national: bool) -> DataFrame:
    """One of two company registries; some companies have no code."""
    key = F.col("s_suppkey")
    chosen = supplier.where((F.col("s_nationkey") < 13) == F.lit(national))
    return chosen.select(
        F.when(key % 13 == 0, "").otherwise(_airline("s_suppkey", 90)).alias("icao"),
        F.concat(F.lit("I"), (key % 36).cast("string")).alias("iata_code"),
        F.col("s_name").alias("legal_name"),
        F.when(key % 2 == 0, "Regular").alias("service"),
        F.concat(F.lit("Cidade "), F.col("s_nationkey").cast("string")).alias("city"),
        F.when(F.col("s_nationkey") < 13, F.concat(
            F.lit("U"), (F.col("s_nationkey") % 5).cast("string"))).alias("state"),
        F.when(F.col("s_acctbal") >= 5000, V.ACTIVE).otherwise("INATIVA").alias("status"),
        F.lit("national.csv" if national else "foreign.csv").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
    )


def raw_aerodromes(nation: DataFrame, region: DataFrame) -> DataFrame:
    """An aerodrome registry with decimal commas, bad altitudes and repeated codes."""
    key = F.col("n_nationkey")
    letter = F.substring(F.lit("BDXK"), (key % 4 + 1).cast("int"), F.lit(1))
    altitude = F.when(key % 7 == 0, "N/D").otherwise(
        F.concat((key * 37).cast("string"), F.lit(","), (key % 10).cast("string")))
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    number = key.cast("string")

    def entries(df: DataFrame, **known: Column) -> DataFrame:
        code = F.concat(F.lit("S"), letter, F.lpad(number, 2, "0"))
        known = {"icao": code} | known
        return df.select(
            *[known.get(name, F.lit(None).cast("string")).alias(name)
              for name in V.AERODROME_COLUMNS.values()],
            F.current_timestamp().alias(INGESTED_AT))

    first = entries(
        nations, ciad=F.concat(F.lit("CI"), number), name=F.col("n_name"),
        municipality=F.concat(F.lit("Cidade "), F.col("n_name")), state=F.col("r_name"),
        served_municipality=F.concat(F.lit("Perto de "), F.col("n_name")),
        served_state=F.when(key % 2 == 0, F.col("r_name")),
        latitude=F.concat(number, F.lit("S")), longitude=F.concat(number, F.lit("W")),
        altitude=altitude, status=F.when(key % 3 != 0, "Cadastrado"))
    second = entries(nations.where(key < 3), name=F.concat(F.lit("Z "), F.col("n_name")),
                     altitude=F.lit("10,5"))
    return first.unionByName(second)


@dataclass
class Flights:
    """The layers of the flight model over one folder of benchmark tables, built on demand.

    ``silver``, ``airports`` and ``obt`` are tables, as in any layered lake: the first use in an
    application writes them to the shared folder, later uses read them. ``bronze`` follows from
    the line items row by row and ``fact`` takes one shuffle of the step keys, so both are plans:
    writing them would cost more than it saves. The ``derived_*`` forms are not written either,
    and read no written layer but the small airports.
    """

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _trace(self) -> str:
        inputs = ["lineitem", "supplier", "nation", "region"]
        return fingerprint(self.spark, *[f"{self.folder}/{name}.parquet" for name in inputs])

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return stored_once(self.spark, f"{self._trace}/{name}", build)

    @cached_property
    def national(self) -> DataFrame:
        return raw_companies(self.table("supplier"), national=True)

    @cached_property
    def foreign(self) -> DataFrame:
        return raw_companies(self.table("supplier"), national=False)

    @cached_property
    def bronze_aerodromes(self) -> DataFrame:
        return raw_aerodromes(self.table("nation"), self.table("region"))

    @cached_property
    def airlines(self) -> DataFrame:
        return silver.airlines({"national": self.national, "foreign": self.foreign})

    @cached_property
    def aerodromes(self) -> DataFrame:
        return silver.aerodromes(self.bronze_aerodromes)

    @cached_property
    def codes(self) -> DataFrame:
        return silver.operation_codes(bronze.operation_codes(self.spark))

    def derived_bronze(self) -> DataFrame:
        return raw_steps(self.table("lineitem"))

    def derived_silver(self) -> DataFrame:
        return silver.flights(self.derived_bronze())

    def derived_airports(self) -> DataFrame:
        return gold.dim_airport(self.derived_silver(), self.aerodromes)

    def derived_fact(self) -> DataFrame:
        return gold.fact_flights(self.derived_silver(), self.airlines, self.codes)

    @property
    def steps(self) -> DataFrame:
        """The distinct step keys, from which the fact follows."""
        return distinct_rows(self.derived_silver(), gold.STEP_KEYS)

    def derived_obt(self) -> DataFrame:
        return gold.obt_flights(self.fact, self.airports)

    @cached_property
    def bronze(self) -> DataFrame:
        return self.derived_bronze()

    @cached_property
    def silver(self) -> DataFrame:
        return self._stored("silver_vra", self.derived_silver)

    @cached_property
    def airports(self) -> DataFrame:
        return self._stored("dim_airport", self.derived_airports)

    @cached_property
    def fact(self) -> DataFrame:
        return self.derived_fact()

    @cached_property
    def obt(self) -> DataFrame:
        return self._stored("obt_flights", self.derived_obt)

    @cached_property
    def marked(self) -> DataFrame:
        registries = {"airline_codes": self.airlines, "aerodrome_codes": self.aerodromes}
        keys = [self._stored(name, df.select("icao").distinct) for name, df in registries.items()]
        return contract.marked(self.silver, *keys, unique=True)
