"""Facts: atomic batches, the index of their keys, changed columns, compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS
from starlane.plans.load import Loader
from starlane.session import new_folder
from starlane.sinks.facts import FactTable
from starlane.sinks.store import Store
from tests.conftest import rows_of


@pytest.fixture
def table(spark):
    return FactTable(spark, new_folder(spark, "fact"))


def keyed(frame, *numbers, extra="x"):
    return frame("k long, v string", *[(n, extra) for n in numbers])


def test_batch_is_replaced_in_one_step(table, frame):
    assert table.read() is None
    assert table.replace(keyed(frame, 1, 2), "a", ("k",)) == 2
    snapshot = table.snapshot()
    row = table.stage(keyed(frame, 3), "a", ("k",))
    assert rows_of(table.read(), "k") == [(1,), (2,)]
    table.commit([row])
    assert rows_of(table.read()) == [(3, "x", "a")]
    # A reader that began before keeps its rows.
    assert rows_of(table.read(snapshot), "k") == [(1,), (2,)]
    assert table.replace(keyed(frame, 1).limit(0), "a", ("k",)) == 0
    assert table.read().columns == ["k", "v", "batch_id"] and table.read().count() == 0


def test_failed_write_leaves_the_old_rows(table, frame):
    table.replace(keyed(frame, 1, 2), "a", ("k",))
    with pytest.raises(Exception, match="broken"):
        bad = keyed(frame, 7, 8).withColumn("v", F.when(F.col("k") == 8, F.raise_error(F.lit("broken"))))
        table.replace(bad, "a", ("k",))
    assert rows_of(table.read(), "k") == [(1,), (2,)]


def events(frame, *ids):
    rows = [(i, "t", "1", "2024-01-01 10:00:00", "x", "y", "n") for i in ids]
    return frame(", ".join(f"{c} string" for c in CONTRACTS["ticket_events"].columns), *rows)


def test_load_killed_before_its_commit(spark, frame, monkeypatch):
    loader = Loader(Store(spark, new_folder(spark, "store")))
    loader.store.write_dimension(frame("agent_id long", (1,)), "agents", 1)
    loader.load_fact("ticket_events", events(frame, "a", "b"), "e-1", 1)

    def die(self, rows):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(FactTable, "commit", die)
        with pytest.raises(RuntimeError):
            loader.load_fact("ticket_events", events(frame, "c"), "e-1", 2)
    assert rows_of(loader.store.fact("ticket_events"), "event_id") == [("a",), ("b",)]
    loader.load_fact("ticket_events", events(frame, "c"), "e-1", 2)
    assert rows_of(loader.store.fact("ticket_events"), "event_id") == [("c",)]


def test_counts_come_with_the_rows(spark, frame):
    loader = Loader(Store(spark, new_folder(spark, "store")))
    loader.store.write_dimension(frame("agent_id long", (1,)), "agents", 1)
    spark.sparkContext.setJobGroup("load", "load")
    loader.load_fact("ticket_events", events(frame, "a", "b", "b", "b"), "e-1", 1)
    loader.load_fact("ticket_events", events(frame, "a", "c"), "e-2", 2)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("load"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = {(r.batch_id, r.metric_name): r.metric_value for r in loader.store.metrics().collect()}
    for batch, (kept, again) in {"ticket_events-e-1": (2, 2), "ticket_events-e-2": (1, 1)}.items():
        assert (found[batch, "clean_records"], found[batch, "duplicates"]) == (kept, again)
        assert found[batch, "orphans"] == 0
    assert jobs <= 64, jobs  # 62 when this was written


def test_key_index_reads_only_what_can_match(table, frame):
    table.replace(keyed(frame, *range(0, 100)), "low", ("k",))
    table.replace(keyed(frame, *range(1000, 1100)), "high", ("k",))
    known = table.known_keys(keyed(frame, 1005, 1006, 5000), ["k"], "new")
    assert {(1005,), (1006,)} <= set(rows_of(known))
    files = known.inputFiles()
    high = [r.folder for r in table.snapshot() if r.batch_id == "high"]
    assert files and all(f"load={high[0]}" in f for f in files)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(k,1005)" in plan
    # No batch's range, no key, or only the batch itself: nothing to read.
    assert table.known_keys(keyed(frame, 500), ["k"], "new") is None
    assert table.known_keys(keyed(frame, None), ["k"], "new") is None
    assert table.known_keys(keyed(frame, 1005), ["k"], "high") is None


@pytest.mark.parametrize("compacted", [False, True])
def test_key_index_has_all_keys(table, frame, compacted):
    table.replace(frame("a string, b long, v string", ("x", 1, ""), ("é", 2, ""), (None, 3, "")), "1", ("a", "b"))
    table.replace(frame("a string, b long, v string", ("x", 2, ""), ("z", None, "")), "2", ("a", "b"))
    if compacted:
        assert table.compact() == 2
        table.replace(frame("a string, b long, v string", ("q", 9, "")), "2", ("a", "b"))
    incoming = frame("a string, b long", ("x", 1), ("x", 2), ("é", 2), ("q", 9), (None, 3), ("z", None))
    stored = set(rows_of(table.known_keys(incoming, ["a", "b"], "3")))
    want = {("x", 1), ("é", 2)} | ({("q", 9)} if compacted else {("x", 2)})
    assert stored & set(rows_of(incoming)) == want


def test_widened_key_is_still_found(table, frame):
    table.replace(frame("k int, v string", (5, "x")), "1", ("k",))
    known = table.known_keys(keyed(frame, 5, 6), ["k"], "2")
    assert rows_of(known) == [(5,)]


def test_columns_and_types_change(table, frame):
    table.replace(frame("k int, v int, w string", (1, 2, "a")), "1")
    table.replace(frame("k long, w int, v double, n string", (2**40, 7, 0.5, "new")), "2")
    whole = table.read()
    assert [(f.name, f.dataType.simpleString()) for f in whole.schema] == [
        ("k", "bigint"), ("v", "double"), ("w", "string"), ("n", "string"), ("batch_id", "string")]
    assert rows_of(whole) == [(1, 2.0, "a", None, "1"), (2**40, 0.5, "7", "new", "2")]


def test_compaction_keeps_batches_apart(table, frame):
    for name in ("a", "b", "007"):
        table.replace(keyed(frame, *range(5), extra=name), name, ("k",))
    before = rows_of(table.read())
    assert table.compact() == 3 and table.compact(small=1) == 0
    assert rows_of(table.read()) == before
    assert len({r.folder for r in table.snapshot()}) == 1
    table.replace(keyed(frame, 9, extra="new"), "b", ("k",))
    assert rows_of(table.read()) == sorted([r for r in before if r[2] != "b"] + [(9, "new", "b")], key=repr)
    assert table.expire() == 3
    assert table.read().count() == 11
    assert table.compact() == 3 and table.read().count() == 11 and table.expire() == 2
    assert table.read().count() == 11
