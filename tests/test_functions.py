from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tarmaq.functions import clock, labels, measures, predicates, typing


def values(spark, kind, items, column):
    df = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(column(F.col("x"))).collect()]


MOMENT = datetime(2025, 8, 1, 10, 20)


def test_lenient_wall_clock(spark):
    texts = ["null", "", "10:20", "2025", "2025-08-01", "2025-08-01 10:20:00.000", "never", None]
    typed = values(spark, "string", texts,
                   lambda x: typing.to_wall_clock(typing.without_token(x, "null")))
    assert typed == [None, None, None, datetime(2025, 1, 1), datetime(2025, 8, 1), MOMENT, None,
                     None]


def test_strict_wall_clock(spark):
    texts = ["2025", "2025-08-01", "2025-08-01 10:20", "2025-08-01 10:20:00.000", "2025-02-30 10:20"]
    typed = values(spark, "string", texts, lambda x: typing.to_wall_clock(x, strict=True))
    assert typed == [None, None, MOMENT, MOMENT, None]


def test_decimal_comma(spark):
    texts = ["12,5", "12.5", "1.234,5", "N/D", "", None, "-3,25"]
    assert values(spark, "string", texts, typing.decimal_comma) == [
        12.5, 12.5, None, None, None, None, -3.25]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_minutes_between(spark, zone):
    pairs = [
        (datetime(2025, 8, 1, 10, 0, 50), datetime(2025, 8, 1, 10, 2, 10), 1),
        (datetime(2025, 8, 1, 10, 2, 10), datetime(2025, 8, 1, 10, 0, 50), -1),
        (datetime(2025, 8, 1, 23, 50), datetime(2025, 8, 2, 0, 10), 20),
        # Clocks in Brazil jumped from 00:00 to 01:00 on this day.
        (datetime(2018, 11, 3, 23, 30), datetime(2018, 11, 4, 0, 30), 60),
        (datetime(2025, 8, 1), None, None),
        (datetime(1, 1, 1), datetime(9999, 1, 1), None),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz, wanted int")
        found = df.select(clock.minutes_between(F.col("a"), F.col("b")).alias("m"), "wanted",
                          clock.time_of_day(F.col("b"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row[0] for row in found] == [row[1] for row in found]
    assert [row[2] for row in found] == ["10:02", "10:00", "00:10", "00:30", None, "00:00"]


def test_weekday_and_month(spark):
    days = [date(2025, 8, 3), date(2025, 8, 9), date(2025, 8, 31), None]
    names = ["domingo", "segunda", "terca", "quarta", "quinta", "sexta", "sabado"]
    assert values(spark, "date", days, lambda x: clock.weekday_name(x, names)) == [
        "domingo", "sabado", "domingo", None]
    assert values(spark, "date", days, clock.month_start) == [date(2025, 8, 1)] * 3 + [None]


def test_predicates_judge_nulls(spark):
    delays = [-121, -120, 1440, 1441, None]
    assert values(spark, "int", delays, lambda x: predicates.within_or_unknown(x, -120, 1440)) == [
        False, True, True, False, True]
    assert values(spark, "int", delays, lambda x: predicates.outside(x, -120, 1440)) == [
        True, False, False, True, False]
    assert values(spark, "string", ["A", "", None], predicates.key_present) == [True, False, False]
    assert values(spark, "int", [1, 0, None], lambda x: predicates.after_or_unknown(x, F.lit(0))
                  ) == [True, False, True]


def test_punctual_is_three_valued(spark):
    delays = [15, 16, -100, None]
    assert values(spark, "int", delays,
                  lambda x: predicates.at_most_when_judgeable(x, 15, F.lit(True))) == [
        True, False, True, None]
    assert values(spark, "int", [1], lambda x: predicates.at_most_when_judgeable(
        x, 15, F.lit(False))) == [None]


def test_labels(spark):
    assert values(spark, "string", ["1", None],
                  lambda x: labels.or_fallback(F.lit(None).cast("string"), "unknown", x)) == [
        "unknown (1)", None]
    assert values(spark, "string", ["SBGR", None], lambda x: labels.pair_label(x, F.lit("SBSP"))
                  ) == ["SBGR - SBSP", None]


def test_measures(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    assert df.agg(
        measures.rows_where(F.col("ok")), measures.sum_where(~F.col("ok")),
        measures.percent_true(F.col("ok")), measures.percent_true(F.col("ok"), F.count("ok")),
    ).first() == (1, 1, 100 / 3, 50.0)
    empty = df.where("false").agg(
        measures.rows_where(F.col("ok")), measures.sum_where(F.col("ok")),
        measures.percent_true(F.col("ok"))).first()
    assert empty == (0, None, None)
