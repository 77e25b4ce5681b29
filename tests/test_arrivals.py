from tarmaq.plans import vocabulary as V
from tarmaq.streaming.arrivals import load_arrivals
from tests.conftest import rows

LINE = "AZU;{};0;N;SBGR;SBSP;2025-08-01 10:00:00;2025-08-01 10:05:00;" \
       "2025-08-01 11:00:00;null;REALIZADO;N/A"


def test_each_file_is_loaded_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "silver")
    folder.mkdir()

    def arrive(month, *numbers):
        lines = ["preamble", ";".join(V.FLIGHT_COLUMNS), *[LINE.format(n) for n in numbers]]
        (folder / f"VRA_{month}.csv").write_text("\n".join(lines) + "\n")

    def load():
        load_arrivals(spark, str(folder), target, str(tmp_path / "done")).awaitTermination()
        loaded = spark.read.parquet(target)
        return rows(loaded.select("flight_number", "departure_delay_min", "_arquivo_origem"))

    arrive(1, "1", "2")
    first = [("1", 5, "VRA_1.csv"), ("2", 5, "VRA_1.csv")]
    assert load() == first
    assert load() == first
    arrive(2, "2", "3")
    assert load() == sorted([*first, ("2", 5, "VRA_2.csv"), ("3", 5, "VRA_2.csv")])
