from __future__ import annotations

import json

from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS
from starlane.functions.rows import conform
from starlane.operators import gates
from tests.conftest import rows_of

CUSTOMERS = CONTRACTS["customers"]
TEXT = "customer_id string, full_name string, email string, phone string, region_id string, segment_id string, signup_date string"


def test_first_failing_check_wins(frame):
    raw = frame(
        TEXT,
        ("1", "a", "a@b.co", "0100000000", "5.0", "1", "2024-01-15"),
        ("2", "a", "nomail", "N/A", "x", "1", "invalid"),
        ("3", "a", "nomail", "N/A", None, "1", None),
        ("4", "a", None, None, None, "NaN", None),
        (None, "a", None, None, "1", "1", None),
    )
    flagged = gates.flag_rows(raw, CUSTOMERS)
    assert rows_of(flagged.select("full_name", "customer_id", gates.ERROR_TYPE, F.array_join(gates.FAILED, ","))) == sorted(
        [
            ("a", "1", None, None),
            ("a", "2", "TYPE_MISMATCH", "region_id,signup_date"),
            ("a", "3", "FORMAT_ERROR", "email,phone"),
            ("a", "4", "NULL_REQUIRED_COLUMN", "region_id,segment_id"),
            ("a", None, "NULL_REQUIRED_COLUMN", "customer_id"),
        ],
        key=repr,
    )
    clean, bad = gates.clean_rows(flagged, CUSTOMERS), gates.bad_rows(flagged)
    assert clean.count() + bad.count() == raw.count()
    assert rows_of(clean, "customer_id", "region_id") == [(1, 5)]


def test_error_ids(frame):
    raw = frame(
        TEXT,
        ("1", "a", "nomail", None, "5", "1", None),
        (None, "b", "nomail", None, "5", "1", None),
        (None, "c", None, None, "x", "1", None),
        (None, "d", None, None, "1", "1", None),
        ("9", "e", None, None, None, "1", None),
    )
    errors = gates.error_rows(gates.bad_rows(gates.flag_rows(raw, CUSTOMERS)), CUSTOMERS, "b")
    found = {json.loads(r["raw_payload"])["row"]["full_name"]: r for r in errors.collect()}
    assert found["a"]["event_id"] == "customers:1"
    assert found["b"]["event_id"] is None
    assert found["c"]["event_id"].startswith("type_")
    assert found["d"]["event_id"].startswith("null_row_")
    assert found["e"]["event_id"] == "9"
    assert found["e"]["error_column"] == "region_id" and not found["e"]["retryable"]
    assert found["a"]["error_column"] == "email" and found["a"]["retryable"]
    assert found["c"]["error_column"] == "multiple" and not found["c"]["retryable"]


def test_payload_keeps_nulls_and_iso_times(spark):
    df = spark.sql("SELECT 'o' AS order_id, timestamp_ntz'2024-01-02 03:04:05' AS order_created_at, CAST(NULL AS BIGINT) AS customer_id")
    none = F.lit(None).cast("string")
    body = gates.payload(df, df.columns, "orders", F.lit("FK_MISSING"), F.lit("customer_id"), none)
    text = json.loads(df.select(body).collect()[0][0])
    assert text["row"] == {
        "order_id": "o", "order_created_at": "2024-01-02T03:04:05", "customer_id": None
    }
    assert text["fk_table"] is None and text["table_name"] == "orders"


def test_all_rows_bad(frame):
    raw = frame(TEXT, ("x", "a", None, None, "1", "1", None))
    sides = gates.split_types(raw, CUSTOMERS)
    assert sides.clean.isEmpty() and sides.bad.count() == 1


def test_typed_columns_need_no_cast(frame):
    orders = CONTRACTS["orders"]
    df = conform(frame("order_id string, customer_id int, order_amount decimal(10,2)", ("a", 1, None)), orders)
    assert gates.split_types(df, orders).bad.isEmpty()


def test_negative_amounts_pass(frame):
    raw = frame(
        "order_id string, customer_id string, restaurant_id string, driver_id string, region_id string, order_amount string",
        ("a", "1", "1", "1", "1", "-5.5"),
    )
    flagged = gates.flag_rows(raw, CONTRACTS["orders"])
    assert gates.bad_rows(flagged).isEmpty()


def test_column_check():
    teams = CONTRACTS["teams"]
    assert gates.check_columns(["TEAM_NAME", "Team_Id"], teams).passed
    assert "count" in gates.check_columns(["team_id"], teams).reason
    assert gates.check_columns(["team_id", "name"], teams).reason == "missing team_name"


def test_file_name_check():
    assert gates.check_file_name("/x/batch/2024-01-01/Customers.CSV").passed
    assert not gates.check_file_name("/x/unknown.csv").passed
