"""The fact by months: arrivals and corrections give what a full refresh gives."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarmaq.plans import gold, increment
from tarmaq.plans.catalogue import timeless
from tarmaq.sources.months import append_parts, in_parts, part_values, read_parts, replace_parts
from tests.conftest import plan, rows


def whole(flights):
    return rows(timeless(flights.fact))


def read(spark, path, flights):
    return rows(timeless(read_parts(spark, path, flights.fact)))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_loads_gives_the_full_refresh(spark, flights, tmp_path, seed):
    path, draw = str(tmp_path / "fact"), random.Random(seed)
    bounds = sorted(draw.sample(range(1, 97), 2))
    dealt = flights.silver.withColumn("deal", F.pmod(F.xxhash64(
        F.lit(seed), "flight_number", "_arquivo_origem"), F.lit(97)))
    loads = [dealt.where(F.col("deal").between(a, b - 1)).drop("deal")
             for a, b in zip([0, *bounds], [*bounds, 97], strict=True)]
    for load in loads:
        increment.add_arrivals(load, path, flights.airlines, flights.codes)
    assert read(spark, path, flights) == whole(flights)
    increment.add_arrivals(loads[1], path, flights.airlines, flights.codes)  # once more
    assert read(spark, path, flights) == whole(flights)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_a_changed_month_rewrites_that_month_only(spark, flights, tmp_path):
    path, month = str(tmp_path / "fact"), date(1995, 3, 1)
    replace_parts(flights.fact.where((F.col("reference_month") != F.lit(month))
                                     | F.col("reference_month").isNull()
                                     | (F.col("flight_number") > "3")), path, "reference_month")
    before = files(path)
    increment.rebuild_months(flights.silver, [month], path, flights.airlines, flights.codes)
    after = files(path)
    changed = {f for f in set(before) | set(after) if before.get(f) != after.get(f)}
    assert changed and {Path(f).parent.name for f in changed} == {"reference_month=1995-03-01"}
    assert read(spark, path, flights) == whole(flights)
    increment.rebuild_months(flights.silver, [None], path, flights.airlines, flights.codes)
    assert read(spark, path, flights) == whole(flights)


def test_files_of_a_month_are_few_and_large_months_are_split(spark, tmp_path):
    rows_in = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 5).cast("string")).alias("part"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    few = str(tmp_path / "few")
    replace_parts(rows_in, few, "part")
    assert all(len(list(folder.glob("*.parquet"))) == 1 for folder in Path(few).glob("part=*"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        split = str(tmp_path / "split")
        replace_parts(rows_in, split, "part")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list(Path(split, "part=hot").glob("*.parquet"))) > 2
    assert spark.read.parquet(split).count() == 60_000


def test_known_keys_are_read_from_touched_months_only(spark, flights, tmp_path):
    path, month = str(tmp_path / "fact"), date(1995, 3, 1)
    append_parts(flights.fact, path, "reference_month")
    known = read_parts(spark, path, flights.fact).where(in_parts("reference_month", [month, None]))
    shown = plan(known.select(*gold.STEP_KEYS))
    assert "PartitionFilters: [(" in shown and "airline_name" not in shown
    scanned = {f.split("reference_month=")[1][:10] for f in known.inputFiles()}
    assert len(scanned) > 10  # the listing is whole, the scan is pruned by the filter above
    assert {r[0] for r in known.select("reference_month").distinct().collect()} == {month, None}


def test_parts_are_few(spark):
    df = spark.range(30).withColumn("part", F.col("id") % 7)
    assert sorted(part_values(df, "part")) == list(range(7))
    with pytest.raises(ValueError, match="more than 20"):
        part_values(df, "id", most=20)
    assert df.where(in_parts("part", [])).count() == 0


def test_empty_load_changes_nothing(spark, flights, tmp_path):
    path = str(tmp_path / "fact")
    increment.add_arrivals(flights.silver.limit(50), path, flights.airlines, flights.codes)
    before = files(path)
    assert increment.add_arrivals(flights.silver.limit(0), path, flights.airlines,
                                  flights.codes) == []
    assert {f: t for f, t in files(path).items() if f in before} == before
    assert read_parts(spark, path, flights.fact).count() <= 50
