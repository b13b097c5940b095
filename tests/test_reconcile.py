from __future__ import annotations

import pytest

from starlane.contracts import CONTRACTS
from starlane.functions.rows import conform
from starlane.plans.drops import load_drop
from starlane.plans.load import Loader
from starlane.session import new_folder
from starlane.sinks.store import Store
from starlane.streaming.reconcile import Reconciliation, latest, registrations, retry
from tests.conftest import rows_of

ORDERS = CONTRACTS["orders"]
SCHEMA = "order_id string, customer_id long, restaurant_id long, driver_id long, region_id long"


@pytest.fixture
def loader(spark):
    return Loader(Store(spark, new_folder(spark, "test")))


def _dims(loader, frame, customers, restaurants, seq=1):
    loader.store.write_dimension(frame("customer_id long", *[(c,) for c in customers]), "customers", seq)
    loader.store.write_dimension(frame("restaurant_id long", *[(r,) for r in restaurants]), "restaurants", seq)
    loader.store.write_dimension(frame("driver_id long", (1,)), "drivers", seq)
    loader.store.write_dimension(frame("region_id long", (1,)), "regions", seq)


def _customers(frame, *ids):
    raw = frame("customer_id string, region_id string, segment_id string", *[(str(i), "1", "1") for i in ids])
    return conform(raw, CONTRACTS["customers"], as_text=True)


def test_state_machine(frame):
    charged = frame(
        "order_id string, fk_column string, fk_value string, dim_name string",
        ("a", "customer_id", "1", "customers"),
        ("a", "customer_id", "1", "customers"),
        ("b", "customer_id", "2", "customers"),
        ("c", "customer_id", None, "customers"),
        ("d", "restaurant_id", "1", "restaurants"),
    )
    log = registrations(charged, ORDERS, 1)
    assert log.count() == 4
    dim = frame("customer_id long", (1,))
    for seq in range(2, 8):
        log = log.unionByName(retry(latest(log), "customers", dim, seq))
        log = log.sparkSession.createDataFrame(log.collect(), log.schema)
    states = latest(log)
    assert rows_of(states, "event_id", "status", "retry_count") == [
        ("a", "RESOLVED", 0), ("b", "DEAD", 5), ("c", "PENDING", 0), ("d", "PENDING", 0),
    ]


def test_one_step_per_run(frame):
    charged = frame(
        "order_id string, fk_column string, fk_value string, dim_name string",
        ("b", "customer_id", "2", "customers"),
    )
    log = registrations(charged, ORDERS, 1)
    dim = frame("customer_id long", (1,))
    log = log.unionByName(retry(latest(log), "customers", dim, 2))
    assert retry(latest(log), "customers", dim, 2).isEmpty()
    assert rows_of(retry(latest(log), "customers", dim, 3), "retry_count") == [(2,)]


def test_replay_loses_and_doubles_nothing(loader, frame):
    _dims(loader, frame, [1], [1])
    orders = conform(
        frame(SCHEMA, ("ok", 1, 1, 1, 1), ("late", 2, 1, 1, 1), ("late", 2, 1, 1, 1), ("twice", 3, 7, 1, 1), ("never", 8, 1, 1, 1)),
        ORDERS,
    )
    loader.load_fact("orders", orders, "b-1", 1)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("ok",)]
    waiting = Reconciliation(loader.store, ORDERS)
    assert rows_of(waiting.states(), "event_id", "dim_name") == [
        ("late", "customers"), ("never", "customers"), ("twice", "customers"),
    ]

    loader.load_dimension("customers", _customers(frame, 1, 2, 3), "c-2", 2)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("late",), ("ok",)]
    assert rows_of(waiting.states(), "event_id", "dim_name", "status", "retry_count") == [
        ("late", "customers", "RESOLVED", 0),
        ("never", "customers", "RETRYING", 1),
        ("twice", "restaurants", "PENDING", 0),
    ]

    loader.replay("orders", "customers", 2)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("late",), ("ok",)]

    loader.store.write_dimension(frame("restaurant_id long", (1,), (7,)), "restaurants", 3)
    loader.replay("orders", "restaurants", 3)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("late",), ("ok",), ("twice",)]


def test_repeated_batch_changes_nothing(loader, frame):
    _dims(loader, frame, [1], [1])
    orders = conform(frame(SCHEMA, ("ok", 1, 1, 1, 1), ("bad", 5, 1, 1, 1), (None, 1, 1, 1, 1)), ORDERS)

    def state():
        return (
            rows_of(loader.store.fact("orders"), "order_id", "batch_id"),
            rows_of(loader.store.errors(), "event_id", "error_type", "error_column", "fk_table", "batch_id"),
            loader.store.metrics().count(),
        )

    loader.load_fact("orders", orders, "b-1", 1)
    once = state()
    loader.load_fact("orders", orders, "b-1", 1)
    assert state() == once
    assert once[0] == [("ok", "b-1")]
    assert [e[1] for e in once[1]] == ["FK_MISSING", "NULL_REQUIRED_COLUMN"]
    loader.load_fact("orders", orders, "b-2", 2)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("ok",)]


def test_repeat_after_a_dimension_arrived(loader, frame):
    _dims(loader, frame, [1], [1])
    orders = conform(frame(SCHEMA, ("O1", 1, 1, 1, 1), ("O2", 2, 1, 1, 1)), ORDERS)
    loader.load_fact("orders", orders, "x-1", 1)
    assert rows_of(loader.store.errors(), "event_id") == [("O2",)]
    loader.store.write_dimension(frame("customer_id long", (1,), (2,)), "customers", 2)
    loader.load_fact("orders", orders, "x-1", 1)
    assert rows_of(loader.store.fact("orders"), "order_id") == [("O1",), ("O2",)]
    assert loader.store.errors().isEmpty()
    waiting = Reconciliation(loader.store, ORDERS)
    assert waiting.states().isEmpty() and waiting.parked().isEmpty()
    found = loader.store.metrics().filter("metric_name in ('orphans', 'clean_records')")
    assert rows_of(found, "metric_name", "metric_value") == [("clean_records", 2.0), ("orphans", 0.0)]


def test_batch_names_that_look_like_numbers(loader, frame):
    _dims(loader, frame, [1], [1])
    orders = conform(frame(SCHEMA, ("O1", 1, 1, 1, 1), ("O2", 1, 1, 1, 1)), ORDERS)
    for name in ("007", "007", "a/b=c 1"):
        loader.load_fact("orders", orders, name, 1)
        assert rows_of(loader.store.fact("orders"), "order_id", "batch_id") == [("O1", "007"), ("O2", "007")]


def test_a_dimension_without_clean_rows_stays(loader, frame):
    loader.load_dimension("teams", frame("team_id string, team_name string", ("1", "A")), "t-1", 1)
    outcome = loader.load_dimension("teams", frame("team_id string, team_name string", ("x", "B")), "t-2", 2)
    assert outcome == "no clean rows"
    assert rows_of(loader.store.dimensions()["teams"], "team_id") == [(1,)]


def test_one_drop_after_another(loader, tmp_path):
    def drop(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    teams = drop("Teams.csv", "TEAM_NAME,team_id\nA,1\nB,x\n,2\n")
    assert load_drop(loader, teams, "d-1", 1) == "loaded"
    assert rows_of(loader.store.dimensions()["teams"], "team_id", "team_name") == [(1, "A")]
    assert rows_of(loader.store.errors(), "event_id", "error_type", "batch_id") == [
        ("2", "NULL_REQUIRED_COLUMN", "d-1"), ("x", "TYPE_MISMATCH", "d-1"),
    ]
    again = drop("teams.v2.csv", "TEAM_NAME,team_id\nA,1\nB,x\n,2\n")
    assert load_drop(loader, again, "d-2", 2) == "already processed"
    assert load_drop(loader, drop("channels.csv", "channel_id\n1\n"), "d-3", 3).startswith("column")
    assert load_drop(loader, drop("reasons.xml", "<x/>"), "d-4", 4) == "unsupported format"
    assert load_drop(loader, drop("cities.csv", "city_id,city_name,country,timezone\n"), "d-5", 5) == "empty"
    assert load_drop(loader, drop("segments.csv", "segment_id,segment_name,discount_pct,priority_support\nx,a,1,true\n"), "d-6", 6) == "no clean rows"
    assert loader.store.errors().filter("batch_id = 'd-6'").count() == 1
    failed = loader.store.metrics().filter("metric_name = 'files_failed' AND metric_value > 0")
    assert rows_of(failed, "table_name") == [("channels",), ("reasons",), ("segments",)]
