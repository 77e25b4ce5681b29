from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmaq.operators import quality
from tarmaq.plans import contract
from tarmaq.plans import vocabulary as V
from tests.conftest import rows

T = datetime(2025, 8, 1, 10)
LATER = datetime(2025, 8, 1, 12)
SCHEMA = ("name string, scheduled_departure timestamp_ntz, scheduled_arrival timestamp_ntz, "
          "actual_departure timestamp_ntz, actual_arrival timestamp_ntz, flight_status string, "
          "departure_delay_min int, arrival_delay_min int, empresa_no_cadastro boolean, "
          "origem_no_cadastro boolean, destino_no_cadastro boolean")


def step(name, sd=T, sa=LATER, ad=T, aa=LATER, status="REALIZADO", dd=0, da=0,
         marks=(True, True, True)):
    return (name, sd, sa, ad, aa, status, dd, da, *marks)


STEPS = [
    step("clean"),
    step("status missing", status=None),
    step("status unknown", status="?"),
    step("delay at both limits", dd=-120, da=1440),
    step("departure too early", dd=-121),
    step("arrival too late", da=1441),
    step("lands as it leaves", aa=T),
    step("cancelled", ad=None, aa=None, status="CANCELADO", dd=None, da=None),
    step("no schedule", sd=None, dd=None),
    step("everything", sd=None, sa=None, ad=LATER, aa=T, status=None, dd=2000, da=-500,
         marks=(False, False, False)),
    step("planned backwards", sd=LATER, sa=T),
]


def test_quarantine_reasons(spark):
    df = spark.createDataFrame(STEPS, SCHEMA)
    found = {row["name"]: row[V.REASONS] for row in contract.quarantined(df).collect()}
    names = V.RULE_NAMES
    assert found == {
        "status missing": names[1],
        "status unknown": names[1],
        "departure too early": names[4],
        "arrival too late": names[5],
        "lands as it leaves": names[3],
        "no schedule": names[0],
        "everything": " | ".join([*names[:2], *names[3:]]),
        "planned backwards": names[2],
    }


def test_expectations_and_observation_agree(spark):
    df = spark.createDataFrame(STEPS, SCHEMA)
    rules = contract.flight_rules()
    counted = {r["rule"]: (r["passed"], r["failed"])
               for r in quality.expectation_counts(df, rules).collect()}
    assert list(counted) == V.RULE_NAMES
    assert all(sum(pair) == len(STEPS) for pair in counted.values())
    watched, watch = quality.observed(df, rules, "check")
    assert watched.count() == len(STEPS)
    assert watch.get == {"rows": len(STEPS), **{name: pair[1] for name, pair in counted.items()}}


def test_distribution_counts_each_reason(spark):
    df = spark.createDataFrame(STEPS, SCHEMA)
    bad = contract.quarantined(df)
    spread = {r["reason"]: r["rows"]
              for r in quality.violation_distribution(df, contract.flight_rules()).collect()}
    assert spread[V.RULE_NAMES[1]] == 3 and spread[V.RULE_NAMES[0]] == 2
    assert quality.quarantine_share(bad, df).first() == (8, 11, 100.0 * 8 / 11)


truth = st.sampled_from([True, False, None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(truth, truth, truth), min_size=1, max_size=12))
def test_quarantine_and_clean_rows_are_all_rows(spark, table):
    df = spark.createDataFrame(table, "a boolean, b boolean, c boolean")
    rules = [quality.Rule(name, F.col(name)) for name in "abc"]
    bad = quality.quarantine(df, rules, "why").collect()
    clean = [row for row in table if all(row)]
    assert len(bad) + len(clean) == len(table)
    assert all(row["why"] == " | ".join(n for n in "abc" if not row[n]) for row in bad)


def test_one_implausible_delay_blanks_all_three(spark):
    from tarmaq.plans.gold import plausible_only

    df = spark.createDataFrame(
        [(1, 2000, 10, 1990), (2, 5, 5, 0), (3, None, 5, None), (4, None, -121, None)],
        "id int, departure_delay_min int, arrival_delay_min int, minutes_recovered int")
    assert rows(plausible_only(df)) == [
        (1, None, None, None, True), (2, 5, 5, 0, False), (3, None, 5, None, False),
        (4, None, None, None, True)]


def test_token_profile(spark):
    df = spark.createDataFrame([("null",), (None,), ("1.5",), ("x",)], "`Partida Real` string")
    assert rows(quality.token_profile(df, ["Partida Real"], "null", ".")) == [
        ("Partida Real", 4, 1, 1, 1)]


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert rows(quality.completeness(df, ["a", "b"])) == [(2, 1)]
