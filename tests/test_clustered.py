"""A clustered table lets filters skip row groups; a row chain needs no rescan."""

from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tarmaq.operators.audit import chain_of_counts
from tarmaq.plans import refresh
from tarmaq.sources.clustered import write_clustered
from tarmaq.sources.lake import Lake
from tests.conftest import rows

KEYS = ["reference_month", "icao_airline", "flight_number"]


def groups(path, month, airline):
    """Row groups in all, and those whose ranges leave both values possible."""
    every = possible = 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        columns = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            every += 1
            ranges = [meta.row_group(g).column(columns[c]).statistics for c in KEYS[:2]]
            possible += all(s is None or not s.has_min_max or s.min <= v <= s.max
                            for s, v in zip(ranges, (month, airline), strict=True))
    return every, possible


def test_filters_skip_row_groups(spark, flights, tmp_path):
    month, airline = date(1995, 3, 1), "A007"
    plain, sorted_path = str(tmp_path / "plain"), str(tmp_path / "sorted")
    flights.obt.repartition(16).write.parquet(plain)
    write_clustered(flights.obt, sorted_path, KEYS, files=16)
    _, touched_plain = groups(plain, month, airline)
    every, touched = groups(sorted_path, month, airline)
    assert every >= 16 and touched <= 2 < touched_plain

    def found(path):
        return rows(spark.read.parquet(path).where(
            (F.col("reference_month") == F.lit(month)) & (F.col("icao_airline") == airline)
        ).select(*KEYS))

    assert found(sorted_path) == found(plain)
    assert spark.read.parquet(sorted_path).count() == flights.obt.count()


def test_a_hot_value_is_split(spark, tmp_path):
    df = spark.range(30_000).select(
        F.lit(date(2025, 1, 1)).alias("reference_month"), F.lit("AZU").alias("icao_airline"),
        F.col("id").cast("string").alias("flight_number"))
    write_clustered(df, str(tmp_path / "hot"), KEYS, files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8


def test_row_chain_reads_no_flights(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    steps = {"bronze.vra": 50, "silver.vra": 50, "gold.fact_flights": 47, "gold.obt_flights": 47}
    for name, n in steps.items():
        lake.write(name, spark.range(3))
        lake.write(name, spark.range(n))
    report = refresh.chain_report(lake, accepted_copies=2)
    assert all("/ledger/" in file for file in report.inputFiles())
    assert [(r["step"], r["difference"], r["verdict"]) for r in report.collect()] == [
        ("bronze.vra -> silver.vra", 0, "OK"),
        ("silver.vra -> gold.fact_flights", 3, "CHECK"),
        ("gold.fact_flights -> gold.obt_flights", 0, "OK")]


def test_unknown_counts_are_checked(spark):
    counts = spark.createDataFrame([("a", 5), ("b", None)], "table_name string, rows long")
    report = chain_of_counts(counts, ["a", "b"], [0]).collect()
    assert [(r["difference"], r["verdict"]) for r in report] == [(None, "CHECK")]
