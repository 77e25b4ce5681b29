"""Lines that are no rows: none lost, none loaded, each with its reason."""

import pytest

from tarmaq.plans import refresh
from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import (
    NO_QUOTES,
    REASON,
    REJECTED_LINE,
    SOURCE_FILE,
    accepted,
    read_delimited,
    read_marked,
    rejects,
    with_line_counts,
)
from tarmaq.sources.lake import Lake
from tests.conftest import plan, rows

COLUMNS = ["code", "name", "state"]
GOOD = ["A1;AZU;SP", 'B2;"x ""y"" z";RJ', 'C3;"a;b";MG', ";;", 'D4;12" pipe;SP', "E5;é;",
        '"F6";"";"q"']
BAD = {"G1;short": "too few fields", "G2": "too few fields", "G3;a;b;c": "too many fields",
       ";;;": "too many fields", 'G4;"open;SP': "unbalanced quotes",
       'G5;x;"open': "unbalanced quotes", '"G6;x;y': "unbalanced quotes",
       'G7;"a;b";c;d': "too many fields", 'G8;"a;b"': "too few fields"}


def write(path, *files, encoding="utf-8"):
    path.mkdir()
    for number, lines in enumerate(files):
        text = "\n".join(["preamble", ";".join(COLUMNS), *lines]) + "\n"
        (path / f"{number}.csv").write_text(text, encoding=encoding)
    return str(path)


@pytest.mark.parametrize("split", [None, "64"])
def test_good_and_bad_lines_are_all_lines(spark, tmp_path, split):
    path = write(tmp_path / "in", [*GOOD, *BAD], [*BAD, *GOOD])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        marked = read_marked(spark, path, COLUMNS, escape='"')
        good, bad = accepted(marked), rejects(marked)
        assert good.count() + bad.count() == 2 * (len(GOOD) + len(BAD))
        found = rows(bad.select(REJECTED_LINE, REASON, SOURCE_FILE))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == sorted((line, why, f"{n}.csv") for line, why in BAD.items() for n in (0, 1))
    whole = write(tmp_path / "good", GOOD)
    assert rows(good.select(*COLUMNS).distinct()) == rows(
        read_delimited(spark, whole, COLUMNS, escape='"').distinct())


def test_without_quotes_only_separators_count(spark, tmp_path):
    path = write(tmp_path / "in", ['A;"x;São', 'B;"x;y;z', "C;ç"], encoding="iso-8859-1")
    marked = read_marked(spark, path, COLUMNS, encoding="ISO-8859-1", quote=NO_QUOTES)
    assert rows(accepted(marked).select(*COLUMNS)) == [("A", '"x', "São")]
    assert rows(rejects(marked).select(REJECTED_LINE, REASON)) == [
        ('B;"x;y;z', "too many fields"), ("C;ç", "too few fields")]


def test_counts_come_with_the_write(spark, tmp_path):
    path = write(tmp_path / "in", [*GOOD, *BAD])
    counted, watch = with_line_counts(read_marked(spark, path, COLUMNS, escape='"'), "t")
    accepted(counted).write.parquet(str(tmp_path / "out"))
    assert watch.get == {"lines": len(GOOD) + len(BAD), "rejects": len(BAD)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(GOOD)
    assert plan(accepted(counted)).count("Scan csv") == 1


def test_empty_files(spark, tmp_path):
    marked = read_marked(spark, write(tmp_path / "in", []), COLUMNS)
    assert marked.count() == 0


def test_load_keeps_rejects_in_a_table(spark, tmp_path):
    line = "AZU;{};0;N;SBGR;SBSP;2025-08-01 10:00:00;null;2025-08-01 11:00:00;null;REALIZADO;N/A"
    good = [line.format(i) for i in range(5)]
    folder = tmp_path / "in"
    folder.mkdir()
    header = ["preamble", ";".join(V.FLIGHT_COLUMNS)]
    (folder / "VRA_1.csv").write_text("\n".join([*header, *good, "AZU;7;0"]) + "\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    assert refresh.load_sound_flights(lake, f"{folder}/*.csv") == {"lines": 6, "rejects": 1}
    assert lake.read("bronze.vra").count() == 5
    kept = lake.read("bronze.vra_rejeitadas").collect()
    assert [(r[REJECTED_LINE], r[REASON], r[SOURCE_FILE]) for r in kept] == [
        ("AZU;7;0", "too few fields", "VRA_1.csv")]
