"""Layers that follow row by row are not written, and of the fact only the step keys travel."""

from datetime import date

from pyspark.sql import functions as F

from tarmaq.operators.dedup import distinct_rows
from tarmaq.plans import gold, increment
from tarmaq.plans.catalogue import QUERIES, timeless
from tarmaq.sources.clustered import write_clustered
from tarmaq.sources.months import append_parts, read_parts, replace_parts
from tests.conftest import DATA, plan, rows


def from_given_tables(df):
    files = df.inputFiles()
    return bool(files) and all(DATA in file for file in files)


def test_raw_steps_and_the_fact_are_read_from_the_given_tables(flights):
    assert from_given_tables(flights.bronze) and from_given_tables(flights.fact)
    assert from_given_tables(flights.derived_silver())
    assert not from_given_tables(flights.obt)


def test_named_queries_write_no_layer_before_theirs(flights):
    assert from_given_tables(QUERIES["plausibility_mask"](flights))
    assert from_given_tables(QUERIES["monthly_extremes"](flights))
    assert from_given_tables(flights.derived_airports())


def test_distinct_rows_hold_no_table_before_the_shuffle(spark):
    shown = plan(distinct_rows(spark.range(9).selectExpr("id % 3 AS a", "id % 2 AS b"), ["a", "b"]))
    above, below = shown.split("Exchange hashpartitioning")
    assert "HashAggregate" in above and "HashAggregate" not in below


def keyed(spark, *steps):
    known = {name: "x" for name in gold.STEP_KEYS if name not in gold.MOMENTS}
    return spark.createDataFrame(
        [tuple((known | step).get(name) for name in gold.STEP_KEYS) for step in steps],
        ", ".join(f"{name} {'timestamp_ntz' if name in gold.MOMENTS else 'string'}"
                  for name in gold.STEP_KEYS))


def test_new_steps_shuffle_each_side_once(spark):
    arrived = keyed(spark, {}, {}, {"flight_number": None}, {"flight_number": "2"},
                    {"flight_number": "2"}, {"di_code": None})
    fresh = increment.new_steps(arrived, keyed(spark, {}, {"flight_number": None}))
    shown = plan(fresh)
    assert "Join" not in shown and shown.count("Exchange hashpartitioning") == 1
    assert rows(fresh) == rows(keyed(spark, {"flight_number": "2"}, {"di_code": None}))


def test_months_deal_the_rows_before_they_are_derived(spark, tmp_path):
    df = spark.range(40).select((F.col("id") % 3).cast("string").alias("part"), "id")
    seen = []

    def derive(dealt):
        seen.append((dealt.columns, plan(dealt)))
        return dealt.withColumn("twice", F.col("id") * 2)

    path = str(tmp_path / "parts")
    append_parts(df.where("id < 20"), path, "part", derive)
    append_parts(df.where("id >= 20"), path, "part", derive)
    replace_parts(df.where("part = '1' AND id > 5"), path, "part", derive)
    assert all(c == ["part", "id"] and "REBALANCE_PARTITIONS_BY_COL" in p for c, p in seen)
    assert rows(read_parts(spark, path, derive(df))) == rows(
        df.where("part != '1' OR id > 5").withColumn("twice", F.col("id") * 2))


def test_month_writes_of_steps_equal_the_fact(spark, flights, tmp_path):
    path = str(tmp_path / "fact")
    month = F.coalesce(F.col("reference_month") == F.lit(date(1995, 3, 1)), F.lit(False))
    increment.write_steps(flights.steps, path, flights.airlines, flights.codes, replace_parts,
                          lambda fact: fact.where(~month))
    assert rows(timeless(read_parts(spark, path, flights.fact))) == rows(
        timeless(flights.fact.where(~month)))


def test_clustered_rows_are_derived_after_the_sort(spark, tmp_path):
    path, seen = str(tmp_path / "sorted"), []

    def derive(dealt):
        seen.append(plan(dealt))
        return dealt.withColumn("wide", F.repeat(F.lit("w"), 9))

    write_clustered(spark.range(1000).withColumn("k", F.col("id") % 10), path, ["k", "id"],
                    files=4, derive=derive)
    assert "rangepartitioning" in seen[0] and "Sort" in seen[0]
    found = spark.read.parquet(path)
    spans = found.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("up"))
    assert found.where("wide = 'wwwwwwwww'").count() == 1000 and spans.count() == 4
    assert all(row["up"] - row["low"] <= 3 for row in spans.collect())
