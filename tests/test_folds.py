"""The log of retries, folded: the same states from fewer batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS
from starlane.sinks.store import Store
from starlane.streaming.reconcile import Reconciliation, latest
from tests.conftest import rows_of

ROW = (
    "event_id string, fk_column string, fk_value string, dim_name string, retry_count int,"
    " status string, seq long, step int"
)


@pytest.fixture
def waiting(spark, tmp_path):
    return Reconciliation(Store(spark, str(tmp_path / "store")), CONTRACTS["orders"])


@pytest.fixture
def log(waiting, frame):
    def write(batch_id, *rows):
        moved = [(e, "customer_id", v, "customers", n, s, q, 1) for e, v, n, s, q in rows]
        waiting.append_log(frame(ROW, *moved), batch_id)

    return write


def _agree(waiting):
    assert rows_of(waiting.states()) == rows_of(latest(waiting.log()))


def test_only_later_batches_are_read(waiting, log):
    log("007", ("a", "1", 0, "PENDING", 1), ("b", None, 0, "PENDING", 1))
    log("x y", ("a", "1", 1, "RETRYING", 2), (None, "3", 0, "PENDING", 2))
    waiting.fold()
    _agree(waiting)
    log("z", ("a", "1", 1, "RESOLVED", 3))
    _agree(waiting)
    later = waiting._sides(waiting._fold())[1]
    assert rows_of(later, "batch_id") == [("z",)]
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ("a", "RESOLVED", 3) in rows_of(waiting.states(), "event_id", "status", "seq")


def test_a_repeated_batch_replaces_what_was_folded(waiting, log):
    log("r-1", ("a", "1", 0, "PENDING", 1), ("gone", "2", 0, "PENDING", 1))
    log("r-2", ("a", "1", 1, "RETRYING", 2))
    waiting.fold()
    log("r-1", ("a", "1", 0, "PENDING", 1))
    assert waiting._fold() is None
    _agree(waiting)
    assert rows_of(waiting.states(), "event_id", "status") == [("a", "RETRYING")]
    waiting.fold()
    log("r-1")
    waiting.fold()
    _agree(waiting)
    assert waiting.expire_folds() == 2
    _agree(waiting)


def test_a_fold_that_dies_is_not_seen(waiting, log, monkeypatch):
    log("r-1", ("a", "1", 0, "PENDING", 1))
    waiting.fold()
    log("r-2", ("a", "1", 1, "DEAD", 2))

    def dies(self, path, n_rows):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Reconciliation, "_point_to", dies)
        with pytest.raises(RuntimeError):
            waiting.fold()
    _agree(waiting)
    assert rows_of(waiting.states(), "status") == [("DEAD",)]


def test_folding_waits_for_a_share_of_the_rows(waiting, log):
    assert not waiting.fold_if_due()
    log("r-1", *[(f"e{i}", "1", 0, "PENDING", 1) for i in range(20)])
    assert waiting.fold_if_due()
    log("r-2", ("e1", "1", 1, "RETRYING", 2))
    assert not waiting.fold_if_due()
    _agree(waiting)
    log("r-3", *[(f"e{i}", "1", 1, "RETRYING", 3) for i in range(5)])
    assert waiting.fold_if_due() and not waiting.fold_if_due()
    _agree(waiting)


def test_an_empty_log(waiting):
    waiting.fold()
    assert waiting.states().isEmpty()
    assert waiting.states().where(F.col("status") == "DEAD").isEmpty()
