"""Every query with a SQL counterpart gives the same rows at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.conftest import FOLDER
from tests.parity import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, folder, name):
    outcome, rows, _ = compare(spark, con, folder, name)
    assert outcome in ("match", "rows only")
    assert rows > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["city_name", "region_name", "ticket_count"]


def test_every_answer_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
