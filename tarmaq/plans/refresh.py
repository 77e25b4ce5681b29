"""The whole refinement, files to one big table, as a full and repeatable refresh."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmaq.operators.audit import chain_of_counts
from tarmaq.operators.dedup import require_unique
from tarmaq.operators.quality import observed
from tarmaq.plans import bronze, contract, dictionary, gold, silver
from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import (
    INGESTED_AT,
    REASON,
    REJECTED_LINE,
    SOURCE_FILE,
    accepted,
    rejects,
    with_line_counts,
)
from tarmaq.sources.lake import Lake

EXPECTATIONS = "audit.expectations"


@dataclass(frozen=True)
class Inputs:
    """Where the published files lie."""

    flights: str
    aerodromes: str
    company_folder: str
    #: Keep lines with missing, extra or badly quoted fields out of the flights, in a table of
    #: their own; else they load as far as they can be read.
    reject_lines: bool = False


def load_sound_flights(lake: Lake, path: str) -> dict[str, int]:
    """Load the lines that are rows; the others become ``bronze.vra_rejeitadas``.

    The write of the rows counts all lines, so the files are read again only if some are rejected.
    Returns ``lines`` and ``rejects``.
    """
    marked = bronze.marked_flights(lake.spark, path)
    counted, watch = with_line_counts(marked, "lines")
    lake.build("bronze.vra", lambda: accepted(counted))
    if watch.get["rejects"]:
        lake.build("bronze.vra_rejeitadas", lambda: rejects(marked).select(
            REJECTED_LINE, REASON, SOURCE_FILE, INGESTED_AT))
    return watch.get


def load_bronze(lake: Lake, inputs: Inputs) -> None:
    if inputs.reject_lines:
        load_sound_flights(lake, inputs.flights)
    else:
        lake.build("bronze.vra", lambda: bronze.flights(lake.spark, inputs.flights))
    lake.build("bronze.aerodromos", lambda: bronze.aerodromes(lake.spark, inputs.aerodromes))
    for file, (table, _) in bronze.COMPANY_FILES.items():
        lake.build(f"bronze.{table}", partial(
            bronze.companies, lake.spark, inputs.company_folder, file))
    lake.build("bronze.operation_codes", lambda: bronze.operation_codes(lake.spark))


def build_silver(lake: Lake) -> None:
    lake.build("silver.vra", silver.flights, "bronze.vra")
    labels = [label for _, label in bronze.COMPANY_FILES.values()]
    lake.build("silver.airlines",
               lambda *raw: silver.airlines(dict(zip(labels, raw, strict=True))),
               *[f"bronze.{table}" for table, _ in bronze.COMPANY_FILES.values()])
    lake.build("silver.aerodromes", silver.aerodromes, "bronze.aerodromos")
    lake.build("silver.operation_codes", lambda codes: silver.operation_codes(
        require_unique(codes, ["domain", "code"])), "bronze.operation_codes")


def build_quarantine(lake: Lake) -> Observation:
    """Write the quarantine; the rule counts are observed over all rows in the same pass.

    The counts of each run are kept in the table ``audit.expectations``.
    """
    watches: list[Observation] = []

    def failing(*layers: DataFrame) -> DataFrame:
        audited, watch = observed(contract.marked(*layers), contract.flight_rules(), "contract")
        watches.append(watch)
        return contract.quarantined(audited)

    lake.build("silver.vra_quarentena", failing, "silver.vra", "silver.airlines",
               "silver.aerodromes")
    counts = watches[0].get
    told = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(counts[rule]).cast("bigint")
                              .alias("failed")) for rule in V.RULE_NAMES])
    lake.append(EXPECTATIONS, lake.spark.range(0, 1, 1, 1).select(
        F.current_timestamp().alias("checked_at"), F.lit(counts["rows"]).cast("bigint")
        .alias("rows"), F.inline(told)))
    return watches[0]


def build_gold(lake: Lake) -> None:
    lake.build("gold.dim_airport", gold.dim_airport, "silver.vra", "silver.aerodromes")
    lake.build("gold.fact_flights", gold.fact_flights, "silver.vra", "silver.airlines",
               "silver.operation_codes")
    lake.build("gold.obt_flights", gold.obt_flights, "gold.fact_flights", "gold.dim_airport")


def refresh(lake: Lake, inputs: Inputs) -> dict[str, int]:
    """Rebuild every table; returns the audited rows and the failures of each rule."""
    lake.comments.update(dictionary.MEANINGS)
    load_bronze(lake, inputs)
    build_silver(lake)
    watch = build_quarantine(lake)
    build_gold(lake)
    return watch.get


def chain_report(lake: Lake, accepted_copies: int | None = None) -> DataFrame:
    """Rows from layer to layer; only exact copies may go, and only before the fact.

    The counts are those that each write observed, so no flight is read.
    """
    steps = ["bronze.vra", "silver.vra", "gold.fact_flights", "gold.obt_flights"]
    return chain_of_counts(lake.written_counts(steps), steps, [0, accepted_copies, 0])
