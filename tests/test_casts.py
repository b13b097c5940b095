from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from starlane.functions import casts, times
from tests.conftest import rows_of

NUMBERS = [
    "5", "5.0", "5.7", "2.5", "-2.5", "1e3", " 7 ", "+5", ".5", "5.", "-0.4", "", "x", "1d",
    "1f", "9007199254740993", "9223372036854775807", "9223372036854775808", "1.2.3", "--1",
]
DATES = ["2024-01-15", "2024-1-5", "2024-02-30", "2024", "x", "", "2024-01-15 10:00:00"]
TIMES = [
    "2024-01-15 10:00:00", "2024-01-15T10:00:00", "2024-01-15 10:00:00.123456", "2024-01-15",
    "2024-01-15 10:00", "2024-01-15 25:00:00", "2024", "later", "2024-01-15 10:00:00Z",
    "2024-01-15 10:00:00+02",
]
BOOLEANS = ["true", "FALSE", "t", "f", "1", "0", "yes", "no", "y", "n", " true ", "2", ""]


@pytest.mark.parametrize(
    "type_name, sql_type, values",
    [
        ("int", "BIGINT", NUMBERS),
        ("float", "DOUBLE", NUMBERS),
        ("date", "DATE", DATES),
        ("timestamp", "TIMESTAMP", TIMES),
        ("boolean", "BOOLEAN", BOOLEANS),
    ],
)
def test_same_as_other_engine(frame, type_name, sql_type, values):
    df = frame("v string", *[(v,) for v in values])
    mine = {r[0]: r[1] for r in df.select("v", casts.from_text(F.col("v"), type_name)).collect()}
    for value in values:
        expected = duckdb.execute(f"SELECT TRY_CAST(? AS {sql_type})", [value]).fetchone()[0]
        assert mine[value] == expected, value


def test_missing_literal(frame):
    df = frame("v string", ("NaN",), ('"NaN"',), ("nan",), ("Nana",))
    assert [r[0] for r in df.select(casts.known(F.col("v"), "float")).collect()] == [
        None, None, None, "Nana",
    ]
    assert df.filter(casts.known(F.col("v"), "string").isNotNull()).count() == 4


def test_nan_to_null(frame):
    df = frame("v double", (float("nan"),), (1.5,), (None,))
    assert [r[0] for r in df.select(casts.nan_to_null(F.col("v"))).collect()] == [None, 1.5, None]


def test_minutes_and_date_ids_ignore_the_session_zone(spark):
    start, end = dt.datetime(2024, 3, 31, 1, 30), dt.datetime(2024, 3, 31, 3, 30, 0, 500000)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([(start, end), (None, end)], "a timestamp_ntz, b timestamp_ntz")
        found = rows_of(
            df.select(times.minutes_between(F.col("a"), F.col("b")), times.date_id(F.col("a")))
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [(7200.5 / 60, 20240331), (None, None)]
