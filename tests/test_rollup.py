"""KPI sums kept by batch: what a refresh reads, and reports equal to those from the fact."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlane.plans import kpi
from starlane.plans.rollup import Rollup
from starlane.session import new_folder
from starlane.sinks.store import Store
from tests.conftest import rows_of

TICKETS = (
    "ticket_id string, order_id string, restaurant_id long, driver_id long, reason_id long, "
    "is_sla_first_breached boolean, is_sla_resolution_breached boolean, is_reopened boolean, "
    "first_response_min double, resolution_min double, refund_amount double, revenue_impact double"
)


def tickets(frame, first, stop):
    return frame(TICKETS, *[
        (f"t{i}", f"o{i % 7}" if i % 11 else None, i % 3, i % 4 if i % 5 else None, i % 2, i % 2 == 0,
         i % 3 == 0, i % 5 == 0, float(i), None if i % 4 else i / 2, i / 10, None if i % 6 == 0 else i / 8)
        for i in range(first, stop)
    ])


@pytest.fixture
def dims(frame):
    return {
        "regions": frame("region_id long, city_name string, region_name string", (1, "A", "x"), (2, "B", "y")),
        "restaurants": frame("restaurant_id long, restaurant_name string", (0, "r0"), (1, "r1"), (1, "r1")),
        "drivers": frame("driver_id long, driver_name string", (0, "d"), (1, "d"), (2, None)),
        "reasons": frame("reason_id long, reason_category_name string", (0, "late")),
    }


def orders(frame, *rows):
    return frame("order_id string, region_id long", *rows)


def check(store, rollup, dims):
    facts, placed, got = store.fact("tickets"), store.fact("orders"), rollup.reports(dims)
    want = {
        "total_tickets": kpi.total_tickets(facts),
        "sla_breach_rate": kpi.sla_breach_rate(facts),
        "average_times": kpi.average_times(facts),
        "reopen_rate": kpi.reopen_rate(facts),
        "refund_and_revenue": kpi.refund_and_revenue(facts),
        "tickets_by_city_region": kpi.tickets_by_city_region(facts, placed, dims["regions"]),
        "tickets_by_restaurant": kpi.tickets_by_restaurant(facts, dims["restaurants"]),
        "tickets_by_driver": kpi.tickets_by_driver(facts, dims["drivers"]),
        "complaint_rate": kpi.complaint_rate(facts, placed),
        "loss_by_reason_category": kpi.loss_by_reason_category(facts, dims["reasons"]),
    }
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == df.columns
        assert rows_of(got[name]) == rows_of(df), name


def test_only_new_changed_and_waiting_batches_are_summed(spark, frame, dims):
    store = Store(spark, new_folder(spark, "store"))
    rollup = Rollup(store)
    assert rollup.refresh() == []
    with pytest.raises(ValueError):
        rollup.merged()
    store.write_fact(tickets(frame, 0, 30), "tickets", "a")
    store.write_fact(tickets(frame, 33, 34), "tickets", "b")  # its order is null
    store.write_fact(orders(frame, ("o1", 1), ("o2", 2), ("o3", None)), "orders", "o-1")
    assert rollup.refresh() == ["a", "b"]
    check(store, rollup, dims)
    assert rollup.refresh() == []
    # A batch is replaced; others are not read again.
    store.write_fact(tickets(frame, 0, 20), "tickets", "a")
    assert rollup.refresh() == ["a"]
    check(store, rollup, dims)
    # New orders concern only batches with tickets that wait for one.
    store.write_fact(orders(frame, ("o4", 1), ("o5", 9)), "orders", "o-2")
    check(store, rollup, dims)
    assert rollup.refresh() == ["a"]
    check(store, rollup, dims)
    # A replaced order batch may move any ticket; an emptied ticket batch counts no more.
    store.write_fact(orders(frame, ("o1", 2), ("o2", 2)), "orders", "o-1")
    store.write_fact(tickets(frame, 0, 0), "tickets", "a")
    assert rollup.refresh() == ["a", "b"]
    check(store, rollup, dims)


def test_a_refresh_that_died_is_caught_up(spark, frame, dims, monkeypatch):
    store = Store(spark, new_folder(spark, "store"))
    rollup = Rollup(store)
    store.write_fact(tickets(frame, 0, 12), "tickets", "a")
    store.write_fact(orders(frame, ("o1", 1)), "orders", "o-1")
    rollup.refresh()
    store.write_fact(tickets(frame, 0, 18), "tickets", "a")

    def die(self, rows):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr("starlane.sinks.facts.FactTable.commit", die)
        with pytest.raises(RuntimeError):
            rollup.refresh()
    assert rollup.merged().where("part = 'all'").agg(F.sum("tickets")).first()[0] == 12
    assert rollup.refresh() == ["a"]
    check(store, rollup, dims)
    # Compaction moves batches without changing them.
    store.write_fact(tickets(frame, 20, 30), "tickets", "b")
    store.fact_table("tickets").compact()
    assert rollup.refresh() == ["b"]
    check(store, rollup, dims)
