from __future__ import annotations

import pytest

from starlane.contracts import CONTRACTS
from starlane.functions.rows import conform
from starlane.operators import integrity
from starlane.operators.duplicates import first_per_key, split_stored
from starlane.operators.lookup import Limits
from tests.conftest import rows_of

ORDERS = CONTRACTS["orders"]
WAYS = [Limits(), Limits(broadcast_rows=0, heavy_rows=1000), Limits(broadcast_rows=0, heavy_rows=2)]


@pytest.fixture
def dims(frame):
    return {
        "customers": frame("customer_id long", (1,), (2,), (2,)),
        "restaurants": frame("restaurant_id long", (1,)),
        "drivers": frame("driver_id long", (1,)),
        "regions": frame("region_id long", (1,), (None,)),
    }


@pytest.fixture
def orders(frame):
    schema = "order_id string, customer_id long, restaurant_id long, driver_id long, region_id long"
    return frame(
        schema,
        ("good", 1, 1, 1, 1),
        ("dim duplicates", 2, 1, 1, 1),
        ("both", 9, 9, 1, 1),
        ("second", 1, 9, 9, 1),
        ("null", 1, 1, None, 1),
        ("copy", 9, 1, 1, 1),
        ("copy", 1, 1, 1, 1),
        ("copy", 1, 9, 1, 1),
    )


@pytest.mark.parametrize("limits", WAYS)
def test_first_missing_reference(orders, dims, limits):
    found = integrity.first_missing(orders, ORDERS, dims, limits)
    assert rows_of(found, "order_id", "fk_column", "fk_value", "dim_name") == sorted(
        [
            ("both", "customer_id", "9", "customers"),
            ("second", "restaurant_id", "9", "restaurants"),
            ("null", "driver_id", None, "drivers"),
            ("copy", "customer_id", "9", "customers"),
            ("copy", "restaurant_id", "9", "restaurants"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("limits", WAYS)
@pytest.mark.parametrize("staged", [False, True])
def test_copies_leave_together(orders, dims, limits, staged):
    sides = integrity.split_orphans(orders, ORDERS, dims, limits, staged)
    assert rows_of(sides.clean, "order_id") == [("dim duplicates",), ("good",)]
    charged = rows_of(sides.charged, "order_id", "fk_column")
    assert charged == [
        ("both", "customer_id"), ("copy", "customer_id"), ("null", "driver_id"),
        ("second", "restaurant_id"),
    ]
    assert sides.clean.columns == orders.columns


def test_absent_dimension_is_skipped(orders, dims):
    few = {"customers": dims["customers"]}
    assert integrity.skipped_references(ORDERS, few) == ["restaurants", "drivers", "regions"]
    found = integrity.first_missing(orders, ORDERS, few)
    assert rows_of(found, "order_id") == [("both",), ("copy",)]


def test_no_references_at_all(orders):
    sides = integrity.split_orphans(orders, ORDERS, {})
    assert sides.clean.count() == orders.count() and sides.charged.isEmpty()


def test_fact_reference_is_not_checked(frame):
    events = frame("event_id string, ticket_id string, agent_id long", ("e", "no such ticket", 1))
    dims = {"agents": frame("agent_id long", (1,)), "tickets": frame("ticket_id string", ("t",))}
    assert integrity.first_missing(events, CONTRACTS["ticket_events"], dims).isEmpty()


@pytest.mark.parametrize("limits", WAYS)
def test_stored_duplicates(frame, limits):
    incoming = frame("a long, b string, v long", (1, "x", 1), (1, "x", 1), (1, "y", 2), (2, "x", 3), (None, "x", 4))
    stored = frame("a long, b string", (1, "x"), (2, "q"), (7, "x"))
    sides = split_stored(incoming, stored, ["a", "b"], limits)
    assert rows_of(sides.new) == sorted([(1, "y", 2), (2, "x", 3), (None, "x", 4)], key=repr)
    assert rows_of(sides.duplicates) == [(1, "x", 1), (1, "x", 1)]


def test_first_per_key_is_deterministic(frame):
    df = frame("k string, v long", ("a", 2), ("a", 1), ("a", None), ("b", 5), ("b", 4))
    expected = [("a", None), ("b", 4)]
    assert rows_of(first_per_key(df, ["k"])) == expected
    assert rows_of(first_per_key(df.orderBy("v"), ["k"])) == expected


def test_conform_adds_typed_nulls(frame):
    df = conform(frame("order_id string", ("a",)), ORDERS)
    assert df.columns == ORDERS.columns
    assert [f.dataType for f in df.schema] == [f.dataType for f in ORDERS.schema]
