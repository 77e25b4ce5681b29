"""Loads that read only new files, batches that may run twice, and counts from footers."""

import shutil

import pytest

from tarmaq.operators.quality import expectation_counts
from tarmaq.plans import contract
from tarmaq.plans import vocabulary as V
from tarmaq.sources.arrived import load_new_files, loaded_files, new_files
from tarmaq.sources.footers import counting_plan, footer_counts
from tarmaq.sources.lake import Lake
from tarmaq.streaming.arrivals import audit_arrivals, write_audited
from tests.conftest import plan, rows


def test_a_second_load_reads_nothing(spark, tmp_path):
    folder, target, ledger = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "ledger")
    folder.mkdir()
    seen = []

    def read(files):
        seen.append(sorted(f.rsplit("/", 1)[1] for f in files))
        return spark.read.text(files)

    def load(name):
        return load_new_files(spark, str(folder), target, ledger, name, read).files

    (folder / "a.txt").write_text("1\n2\n")
    (folder / "b.txt").write_text("3\n")
    assert load("one") == 2 and load("two") == 0 and seen == [["a.txt", "b.txt"]]
    (folder / "c.txt").write_text("4\n")
    (folder / "b.txt").write_text("3\n5\n")  # rewritten, so it is new
    assert load("three") == 2 and seen[1:] == [["b.txt", "c.txt"]]
    assert rows(spark.read.parquet(target).select("load_id", "value")) == [
        ("one", "1"), ("one", "2"), ("one", "3"), ("three", "3"), ("three", "4"), ("three", "5")]
    assert loaded_files(spark, ledger).count() == 4
    assert new_files(spark, str(folder), ledger).isEmpty()


def test_a_load_that_died_before_its_ledger_is_repeated(spark, tmp_path):
    folder, target, ledger = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "ledger")
    folder.mkdir()
    (folder / "a.txt").write_text("1\n")
    load_new_files(spark, str(folder), target, ledger, "x", spark.read.text)
    shutil.rmtree(ledger)  # as if it had ended between its two writes
    load_new_files(spark, str(folder), target, ledger, "x", spark.read.text)
    assert spark.read.parquet(target).count() == 1


def audited(spark, target):
    return {name: rows(spark.read.parquet(f"{target}/{name}").drop(
        "_ingerido_em", "_transformed_at", V.QUARANTINED_AT))
        for name in ("flights", "quarantine", "expectations")}


def test_a_batch_that_runs_twice_counts_once(spark, flights, tmp_path):
    target = str(tmp_path / "out")
    batch = flights.silver.limit(700)
    for _ in range(2):
        write_audited(batch, 0, target, flights.airlines, flights.aerodromes)
    found = audited(spark, target)
    assert len(found["flights"]) == 700
    written = spark.read.schema(batch.schema).parquet(f"{target}/flights/batch=0")
    marked = contract.marked(written, flights.airlines, flights.aerodromes)
    counts = expectation_counts(marked, contract.flight_rules())
    assert sorted((r[1], r[2]) for r in found["expectations"]) == sorted(
        (r["rule"], r["failed"]) for r in counts.collect())
    assert len(found["quarantine"]) == contract.quarantined(marked).count() > 0


def test_a_stream_killed_after_its_writes_leaves_the_same_tables(spark, flights, tmp_path):
    folder, target, done = tmp_path / "in", str(tmp_path / "out"), tmp_path / "done"
    folder.mkdir()
    line = ("AZU;{};0;N;SBGR;SBSP;2025-08-01 10:00:00;2025-08-01 10:05:00;"
            "2025-08-01 11:00:00;null;REALIZADO;N/A")
    for month in (1, 2):
        lines = ["preamble", ";".join(V.FLIGHT_COLUMNS), line.format(month), line.format(9)]
        (folder / f"VRA_{month}.csv").write_text("\n".join(lines) + "\n")

    def load():
        audit_arrivals(spark, str(folder), target, str(done), flights.airlines,
                       flights.aerodromes).awaitTermination()
        return audited(spark, target)

    first = load()
    assert len(first["flights"]) == 4 and load() == first
    for commit in (done / "commits").iterdir():  # the batch was written but never committed
        commit.unlink()
    assert load() == first


def test_footers_answer_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    counting = counting_plan(spark, path)
    shown = plan(counting)
    assert "PushedAggregation: [COUNT(*)]" in shown
    assert counting.first()["rows"] == 1000
    assert rows(footer_counts(spark, {"t": path})) == [("t", 1000)]
    assert "PushedAggregation: [COUNT" not in plan(spark.read.parquet(path).groupBy().count())


def test_lake_counts_from_footers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write("footers.a", spark.range(7))
    lake.write("footers.a", spark.range(9))
    assert rows(lake.count_footers(["footers.a", "footers.none"])) == [("footers.a", 9)]


def test_missing_folder(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        new_files(spark, str(tmp_path / "none"), str(tmp_path / "ledger")).count()
