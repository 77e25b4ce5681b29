"""Raw tables: text as it came, plus where and when it came from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import (
    NO_QUOTES,
    read_delimited,
    read_marked,
    renamed,
    require_headers,
    with_ingest_time,
    with_source_file,
)

# Registry file -> (raw table, provenance label).
COMPANY_FILES = {
    "pda_empresas_aereas_nacionais.csv": ("national_airlines", "national"),
    "pda_empresas_aereas_estrangeiros.csv": ("foreign_airlines", "foreign"),
}


def flights(spark: SparkSession, path: str) -> DataFrame:
    """Monthly flight files; accented source headers are kept, and have to be the expected ones."""
    require_headers(spark, path, list(V.FLIGHT_COLUMNS))
    rows = read_delimited(spark, path, list(V.FLIGHT_COLUMNS), escape='"')
    return with_ingest_time(with_source_file(rows))


def marked_flights(spark: SparkSession, path: str) -> DataFrame:
    """:func:`flights` with the lines that are no rows, marked with their text and the reason."""
    require_headers(spark, path, list(V.FLIGHT_COLUMNS))
    return with_ingest_time(read_marked(spark, path, list(V.FLIGHT_COLUMNS), escape='"'))


def aerodromes(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 registry in which a quotation mark is ordinary text."""
    require_headers(spark, path, list(V.AERODROME_COLUMNS), encoding="ISO-8859-1",
                    quote=NO_QUOTES)
    rows = read_delimited(
        spark, path, list(V.AERODROME_COLUMNS), encoding="ISO-8859-1", quote=NO_QUOTES
    )
    return with_ingest_time(renamed(rows, V.AERODROME_COLUMNS))


def companies(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """One company registry file, unmerged. Columns are found by its own header."""
    rows = read_delimited(spark, f"{folder}/{file}")
    return with_ingest_time(with_source_file(renamed(rows, V.COMPANY_COLUMNS), file))


def operation_codes(spark: SparkSession) -> DataFrame:
    """The curated seed of operation codes.

    An Arrow table becomes a local relation, whose exact size lets Catalyst broadcast it.
    """
    columns = zip(*V.OPERATION_CODES, strict=True)
    seed = pa.table(dict(zip(["domain", "code", "description"], columns, strict=True)))
    return spark.createDataFrame(seed)
