"""Every query whose rows have an order: the rows as they come, not sorted by the test."""

from __future__ import annotations

import pytest

from tarmaq.plans import consumption
from tarmaq.plans.catalogue import QUERIES

#: Query -> columns of its order; a minus sign is a descending one. Spark sorts NULLs first
#: ascending and last descending.
ORDERS = {
    "q1_punctuality": ["-dep_on_time_pct", "airline_name"],
    "q1b_judgeable_only": ["-dep_on_time_pct", "airline_name"],
    "q2_routes": ["-flights", "route_municipalities"],
    "q3_cancellation": ["-cancelled", "airline_name"],
    "q4_monthly": ["reference_month", "flight_status"],
    "q5_hourly": ["scheduled_departure_hour"],
    "n1_city_delays": ["-late_departures", "airline_name"],
    "n2_route_cancellation": ["-cancel_pct", "route_icao"],
    "n3_monthly_recovery": ["reference_month"],
    "n4_foreign_cancellations": ["-cancelled", "airline_name"],
    "first_departures": ["scheduled_departure", "icao_airline", "flight_number"],
    "audit_load_summary": ["_arquivo_origem"],
    "registry_key_coverage": ["registry_origin"],
    "tag_listing": ["tag_name", "tag_value"],
    "load_ledger": ["version"],
}


def in_order(rows, columns):
    """``rows`` sorted column by column from the last; Python's sort is stable."""
    for column in reversed(columns):
        name, down = column.lstrip("-"), column.startswith("-")
        some = sorted((r for r in rows if r[name] is not None), key=lambda r: r[name],
                      reverse=down)
        none = [r for r in rows if r[name] is None]
        rows = some + none if down else none + some
    return rows


@pytest.mark.parametrize("name", ORDERS)
def test_rows_come_in_order(flights, name):
    found = QUERIES[name](flights).collect()
    columns = [c.lstrip("-") for c in ORDERS[name]]
    keys = [tuple(r[c] for c in columns) for r in found]
    assert keys == [tuple(r[c] for c in columns) for r in in_order(found, ORDERS[name])]
    assert len(set(keys)) > 1, "one row cannot show an order"


def test_registry_rows_come_in_order(flights):
    found = consumption.registry_rows(flights.airlines, "icao", ["A003", "A001", "A002"]).collect()
    assert [r["icao"] for r in found] == ["A001", "A002", "A003"]
