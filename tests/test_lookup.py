from __future__ import annotations

import pytest

from starlane.operators.lookup import (
    Limits,
    fits_broadcast,
    heavy_keys,
    lookup_join,
    unique_rows,
)
from tests.conftest import rows_of

SMALL = Limits()
FEW_HEAVY = Limits(broadcast_rows=1, heavy_rows=6)
LARGE_EVEN = Limits(broadcast_rows=1, heavy_rows=1000)
LARGE_HEAVY = Limits(broadcast_rows=1, heavy_rows=3)


@pytest.fixture
def sides(frame):
    left = frame(
        "k long, v string",
        *[(1, "same")] * 20,
        *[(i, f"v{i}") for i in range(2, 9)],
        *[(None, "n")] * 4, (99, "absent"), *[(98, "hot and absent")] * 5,
    )
    right = frame("k long, name string", *[(i, f"n{i}") for i in range(1, 8)])
    return left, right


def test_only_null_keys_are_heavy(frame):
    left = frame("k long, v long", *[(None, i) for i in range(9)], (1, 1), (2, 2))
    right = frame("k long, name string", (1, "a"), (3, "c"))
    found = lookup_join(left, right, ["k"], "left", LARGE_HEAVY)
    assert rows_of(found) == rows_of(left.join(right, "k", "left"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [LARGE_EVEN, LARGE_HEAVY, FEW_HEAVY])
def test_all_ways_agree(sides, how, limits):
    left, right = sides
    expected = rows_of(left.join(right, "k", how))
    assert rows_of(lookup_join(left, right, ["k"], how, SMALL)) == expected
    found = lookup_join(left, right, ["k"], how, limits)
    assert rows_of(found.select(left.join(right, "k", how).columns)) == expected


def test_measured_sides(sides, frame):
    left, right = sides
    assert fits_broadcast({"r": right}, Limits(broadcast_rows=7)) == {"r"}
    assert fits_broadcast({"r": right}, Limits(broadcast_rows=6)) == set()
    wide = frame("k long, t string", (1, "x" * 10_000))
    assert fits_broadcast({"w": wide}, Limits(broadcast_bytes=5_000)) == set()
    assert fits_broadcast({}) == set()


def test_heavy_keys(sides):
    left, _ = sides
    assert heavy_keys(left, ["k"], Limits(heavy_rows=100)) is None
    assert rows_of(heavy_keys(left, ["k"], Limits(heavy_rows=5))) == [(1,), (98,)]
    assert rows_of(heavy_keys(left, ["k"], Limits(heavy_rows=4))) == [(1,), (98,), (None,)]
    assert heavy_keys(left, ["k"], Limits(heavy_rows=1)).count() == 11  # no key past the bound is left out


def test_measuring_moves_one_row_a_task(sides, capsys):
    left, right = sides
    lookup_join(left, right, ["k"], "left", LARGE_HEAVY).explain()
    assert "Limit" not in capsys.readouterr().out


def test_heavy_rows_are_not_shuffled(sides):
    left, right = sides
    plan = lookup_join(left, right, ["k"], "left", FEW_HEAVY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text


def test_unique_rows(frame):
    df = frame("k long, a string, b long", (1, "b", 1), (1, "a", 2), (1, "a", 1), (2, None, 3), (2, "z", 1))
    assert rows_of(unique_rows(df, ["k"])) == [(1, "a", 1), (2, None, 3)]
    assert rows_of(unique_rows(df.select("k"), ["k"])) == [(1,), (2,)]


def test_unique_rows_deals_rows_before_it_sorts(frame):
    """One task reads a file of few row groups; the sorting behind it must not be that task's work."""
    rows = [(k % 7 or None, "same" if k % 3 else None, k % 5) for k in range(60)]
    df = frame("k long, a string, b long", *rows).coalesce(1)
    plan = unique_rows(df, ["k"])
    steps = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [x for line in steps for x in ("SortAggregate", "Exchange") if x in line]
    # The lowest deals rows out for the first sorting; groups meet in the other one.
    assert steps == ["SortAggregate", "Exchange", "SortAggregate", "Exchange"]
    lowest = {k: min((r for r in rows if r[0] == k), key=lambda r: (r[1] or "", r[2])) for k, _, _ in rows}
    assert rows_of(plan) == sorted(lowest.values(), key=repr)
