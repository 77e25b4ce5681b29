import pytest
from pyspark.sql import functions as F

from tarmaq.operators import audit
from tarmaq.session import shared_folder
from tarmaq.sources.lake import Lake
from tarmaq.sources.shared import fingerprint, stored_once
from tarmaq.sources.snapshots import load_history, read_snapshot, write_snapshot
from tests.conftest import plan, rows


def test_snapshots_and_history(spark, tmp_path):
    root = str(tmp_path / "t")
    assert load_history(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    assert write_snapshot(spark.range(5), root) == 0
    assert write_snapshot(spark.range(7).withColumn("extra", F.lit("x")), root) == 1
    assert read_snapshot(spark, root, 0).columns == ["id"]
    assert read_snapshot(spark, root).columns == ["id", "extra"]
    assert rows(load_history(spark, root).select("version", "operation", "rows_written")) == [
        (0, "overwrite", 5), (1, "overwrite", 7)]
    with pytest.raises(ValueError, match="latest is 1"):
        read_snapshot(spark, root, 2)


def test_a_failed_load_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(5), root)
    with pytest.raises(Exception, match="boom"):
        write_snapshot(spark.range(9).where(F.raise_error(F.lit("boom")).isNull()), root)
    assert read_snapshot(spark, root).count() == 5
    assert write_snapshot(spark.range(6), root) == 1
    assert read_snapshot(spark, root).count() == 6


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(5), root)
    write_snapshot(read_snapshot(spark, root).where("id > 1"), root)
    assert read_snapshot(spark, root).count() == 3


def test_lake_names_follow_the_latest_snapshot(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write("raw_t.a", spark.range(3))
    lake.write("raw_t.a", spark.range(4).withColumn("n", F.lit(1)))
    assert rows(spark.sql("SELECT count(*), sum(n) FROM raw_t.a")) == [(4, 4)]
    assert lake.read("raw_t.a", 0).count() == 3
    assert lake.tables("raw_t") == ["raw_t.a"] and lake.tables("nowhere") == []
    assert rows(lake.count_tables(["raw_t.a", "raw_t.b"])) == [("raw_t.a", 4), ("raw_t.b", None)]
    assert rows(lake.columns(["raw_t"])) == [
        ("raw_t", "a", "id", "bigint"), ("raw_t", "a", "n", "int")]
    assert lake.history("raw_t.a").count() == 2


def test_lake_partitions_are_pruned(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("part"))
    lake.write("raw_p.a", df, partition_by="part")
    odd = spark.table("raw_p.a").where("part = 1")
    assert odd.count() == 5 and "PartitionFilters: [isnotnull(part" in plan(odd)


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_once_builds_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(4)

    for _ in range(2):
        assert stored_once(spark, "four", build).count() == 4
    assert len(calls) == 1


def test_fingerprint_sees_new_files(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(3).write.parquet(path)
    before = fingerprint(spark, path)
    assert before == fingerprint(spark, path)
    spark.range(3).write.mode("append").parquet(path)
    assert before != fingerprint(spark, path)


def test_reconcile_and_chain(spark):
    three, two = spark.range(3), spark.range(2)
    assert audit.reconcile([three, two], spark.range(5)).first() == (5, 5, 0)
    chain = audit.row_chain([("a", three), ("b", three), ("c", two)], [0, 0])
    assert rows(chain) == [("a -> b", 3, 3, 0, 0, "OK"), ("b -> c", 3, 2, 1, 0, "CHECK")]
    grown = audit.row_chain([("a", two), ("b", three)], [None])
    assert rows(grown) == [("a -> b", 2, 3, -1, None, "CHECK")]


def test_key_skew_counts_everything(spark):
    keys = [("hot",)] * 6 + [("b",)] * 2 + [(None,)] * 3 + [("c",), ("d",)]
    df = spark.createDataFrame(keys, "k string")
    found = audit.key_skew(df, "k", top=2)
    assert rows(found.select("key", "rows", "keys")) == sorted(
        [("hot", 6, 1), (None, 3, 1), ("others", 4, 3)], key=repr)
    assert abs(sum(r["pct_of_rows"] for r in found.collect()) - 100) < 1e-9


def test_extremes_break_ties(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (3,), (4,), (4,), (None,)], "m int")
    assert audit.extremes(df, "m").first() == (1, 1, 4, 2, 4)


def test_lineage_window_prefix_and_blank_source(spark):
    log = spark.createDataFrame([
        ("", "lake.a", "2025-08-10"), (None, "lake.a", "2025-08-09"), ("x", "lake.b", "2025-08-03"),
        ("x", "lake.b", "2025-08-04"), ("old", "lake.c", "2025-08-02"), ("x", "other.d", "2025-08-10"),
    ], "s string, t string, d string")
    edges = audit.lineage_edges(
        log, "s", "t", "d", F.lit("2025-08-10").cast("date"), days=7, prefix="lake.")
    assert rows(edges) == [("(file)", "lake.a"), ("x", "lake.b")]


def test_coverage_rounds(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "")], "t string, c string")
    assert rows(audit.coverage(df, ["t"], F.coalesce(F.col("c") != "", F.lit(False)))) == [
        ("a", 3, 2, 33.3)]


def test_distinct_values_over_two_columns(spark):
    df = spark.createDataFrame([("A", "B"), ("A", ""), (None, "C")], "o string, d string")
    assert rows(audit.distinct_values(df, ["o", "d"], "code")) == [("A",), ("B",), ("C",)]
