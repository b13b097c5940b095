from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS
from starlane.functions.rows import conform
from starlane.plans import views
from starlane.plans.load import Loader
from starlane.session import new_folder
from starlane.sinks import files as out
from starlane.sinks.store import Store
from starlane.sources import files, ledger
from starlane.streaming.ingest import ingest
from tests.conftest import rows_of


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_dimension_versions(spark, frame):
    store = Store(spark, new_folder(spark, "test"))
    assert store.dimensions() == {}
    store.write_dimension(frame("team_id long", (1,), (2,)), "teams", 1)
    first = store.dimensions()["teams"]
    store.write_dimension(frame("team_id long", (3,)), "teams", 2)
    assert rows_of(first) == [(1,), (2,)]
    assert rows_of(store.dimensions()["teams"]) == [(3,)]


def test_ledger(spark, tmp_path):
    a = _write(tmp_path / "in" / "orders.json", "[1]")
    _write(tmp_path / "in" / "copy.json", "[1]")
    _write(tmp_path / "in" / "new.json", "[2]")
    store = Store(spark, str(tmp_path / "store"))
    hashed = ledger.hash_files(spark, a)
    assert rows_of(hashed, "file_hash") == [(hashlib.sha256(b"[1]").hexdigest(),)]
    store.log_files(ledger.ledger_rows(hashed, "b-1"), "b-1")
    fresh = ledger.new_files(
        ledger.hash_files(spark, str(tmp_path / "in")), store.processed_files()
    )
    assert [os.path.basename(r["path"]) for r in fresh.collect()] == ["new.json"]
    assert store.clear_files() == 1
    assert store.processed_files().isEmpty()
    store.log_files(ledger.ledger_rows(hashed, "b-2"), "b-2")
    assert store.processed_files().count() == 1


def test_json_shapes(spark, tmp_path):
    columns = ["city_id", "city_name"]
    array = _write(tmp_path / "a.json", '[\n {"city_id": 1, "city_name": "x"},\n {"city_id": "02"}\n]')
    one = _write(tmp_path / "b.json", '{"city_id": 5.0, "city_name": null}')
    keyed = _write(tmp_path / "c.json", '{"p": {"city_id": 1}, "q": {"city_id": 2, "city_name": "y"}}')
    lines = _write(tmp_path / "d.json", '{"city_id": 1}\n{"city_id": 2}\n')
    assert rows_of(files.read_json(spark, array, columns)) == [("02", None), ("1", "x")]
    assert rows_of(files.read_json(spark, one, columns)) == [("5.0", None)]
    assert rows_of(files.read_keyed_json(spark, keyed, columns)) == [("1", None), ("2", "y")]
    assert rows_of(files.read_json(spark, lines, columns, lines=True)) == [("1", None), ("2", None)]
    assert sorted(files.read_json(spark, array).columns) == columns


def test_csv_keeps_leading_zeros_and_checks_headers(spark, tmp_path):
    path = _write(tmp_path / "t.csv", 'team_id,team_name\n007,"a ""quoted"", name"\n8,\n')
    assert rows_of(files.read_csv(spark, path)) == [("007", 'a "quoted", name'), ("8", None)]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, ["team_name", "team_id"]).collect()


def test_round_trip_of_awkward_text(spark, frame):
    df = frame("k string, v string", ("1", 'a "b", c\\d'), ('q"\\', "é ü 日本"), ("3", None))
    root = new_folder(spark, "test")
    out.write_json(df, f"{root}/a.json")
    out.write_keyed_json(df, "k", f"{root}/b.json")
    out.write_csv(df, f"{root}/c.csv")
    assert rows_of(files.read_json(spark, f"{root}/a.json", df.columns)) == rows_of(df)
    assert rows_of(files.read_keyed_json(spark, f"{root}/b.json", df.columns)) == rows_of(df)
    assert rows_of(files.read_csv(spark, f"{root}/c.csv")) == rows_of(df)


def test_routing(spark):
    paths = [
        "file:/d/batch/2024-01-02/Customers.csv",
        "file:/d/stream/2024-01-02/07/orders.json",
        "s3://b/stream/orders.json/run_date=2024-01-02/run_hour=23/part-0.c000.json",
        "file:/d/readme.txt",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows_of(files.route(df), "table_name", "run_date", "run_hour") == [
        ("", "", ""), ("customers", "2024-01-02", ""), ("orders", "2024-01-02", "07"),
        ("orders", "2024-01-02", "23"),
    ]
    assert files.reader_for("/x/T.CSV") is files.read_csv
    assert files.reader_for("/x/t.xml") is None


def test_stream_of_hourly_files(spark, frame, tmp_path):
    loader = Loader(Store(spark, str(tmp_path / "store")))
    loader.store.write_dimension(frame("agent_id long", (1,)), "agents", 1)
    head = '"ticket_id": "t", "event_ts": "2024-01-01 10:00:00", "old_status": null, "new_status": "x", "notes": null'
    _write(tmp_path / "in/2024-01-01/10/ticket_events.json", f'[{{"event_id": "a", "agent_id": 1.0, {head}}},\n {{"event_id": "b", "agent_id": 2, {head}}}]')
    _write(tmp_path / "in/2024-01-01/11/ticket_events.json", f'[{{"event_id": "c", "agent_id": "x", {head}}}]')

    def run():
        ingest(loader, "ticket_events", str(tmp_path / "in"), str(tmp_path / "cp"), max_files=1).awaitTermination()

    run()
    assert rows_of(loader.store.fact("ticket_events"), "event_id", "agent_id") == [("a", 1)]
    assert rows_of(loader.store.errors(), "event_id", "error_type") == [("b", "FK_MISSING"), ("c", "TYPE_MISMATCH")]
    errors = loader.store.errors().count()
    _write(tmp_path / "in/2024-01-01/12/ticket_events.json", f'[{{"event_id": "c", "agent_id": "x", {head}}}]')
    _write(tmp_path / "in/2024-01-01/13/ticket_events.json", f'[{{"event_id": "a", "agent_id": 1, {head}}}, {{"event_id": "d", "agent_id": 1, {head}}}]')
    run()
    assert rows_of(loader.store.fact("ticket_events"), "event_id") == [("a",), ("d",)]
    assert loader.store.errors().count() == errors
    assert loader.store.processed_files().count() == 3


def test_stream_of_csv_with_an_empty_file(spark, frame, tmp_path):
    loader = Loader(Store(spark, str(tmp_path / "store")))
    columns = CONTRACTS["tickets"].columns
    values = {c: "1" for c in columns if c.endswith("_id")}
    row = ",".join(values.get(c, "") for c in columns)
    _write(tmp_path / "in/1/tickets.csv", f"{','.join(columns)}\n{row}\n")
    _write(tmp_path / "in/2/tickets.csv", f"{','.join(columns)}\n")
    ingest(loader, "tickets", str(tmp_path / "in"), str(tmp_path / "cp"), fmt="csv", max_files=1).awaitTermination()
    fact = loader.store.fact("tickets")
    assert rows_of(fact, "ticket_id", "is_reopened", "revenue_impact") == [("1", False, 0.0)]
    assert "channel_name" in fact.columns


def _orders_json(*ids, without=(), extra=""):
    values = {c: None for c in CONTRACTS["orders"].columns if c not in without}
    keys = {"customer_id": 1, "restaurant_id": 1, "driver_id": 1, "region_id": 1}
    records = [json.dumps({**values, **{k: v for k, v in keys.items() if k in values}, "order_id": i}) for i in ids]
    return "[" + ",\n".join(r[:-1] + extra + "}" for r in records) + "]"


def test_stream_gates_files(spark, frame, tmp_path):
    loader = Loader(Store(spark, str(tmp_path / "store")))
    _write(tmp_path / "in/a b/orders.json", _orders_json("good"))
    _write(tmp_path / "in/x[1]{2}/Orders.v2.json", _orders_json("upper").replace("order_amount", "ORDER_Amount"))
    _write(tmp_path / "in/1/orders.json", _orders_json("lacks", without=("notes", "driver_id", "order_status")))
    _write(tmp_path / "in/2/orders.json", _orders_json("extra", extra=', "more": 1'))
    _write(tmp_path / "in/3/tickets.json", _orders_json("foreign"))
    _write(tmp_path / "in/4/unknown.json", _orders_json("unknown"))
    _write(tmp_path / "in/5/orders.csv", "order_id\nx\n")
    _write(tmp_path / "in/6/orders.json", "[]")
    ingest(loader, "orders", str(tmp_path / "in"), str(tmp_path / "cp")).awaitTermination()
    assert rows_of(loader.store.fact("orders"), "order_id") == [("good",), ("upper",)]
    failed = loader.store.metrics().filter("metric_name = 'files_failed' and metric_details is not null")
    reasons = sorted(r.metric_details.split("/in/")[1] for r in failed.collect())
    assert [r.split(":")[0] for r in reasons] == [
        "1/orders.json", "2/orders.json", "3/tickets.json", "4/unknown.json", "5/orders.csv",
    ]
    counts = loader.store.metrics().filter("metric_details is null")
    assert rows_of(counts.filter("metric_name like 'files%'"), "metric_name", "metric_value") == [
        ("files_failed", 5.0), ("files_processed", 2.0),
    ]


def test_stream_reads_csv_columns_by_name(spark, tmp_path):
    loader = Loader(Store(spark, str(tmp_path / "store")))
    columns = CONTRACTS["ticket_events"].columns
    values = dict(zip(columns, ["e1", "t1", "3", "2024-01-01 10:00:00", "a", "b", "note"]))
    for n, order in enumerate([columns, columns[::-1]]):
        row = ",".join(values[c] if c != "event_id" else f"e{n}" for c in order)
        _write(tmp_path / f"in/{n}/ticket_events.csv", f"{','.join(order)}\n{row}\n")
    ingest(loader, "ticket_events", str(tmp_path / "in"), str(tmp_path / "cp"), fmt="csv").awaitTermination()
    assert rows_of(loader.store.fact("ticket_events"), "event_id", "agent_id", "notes") == [
        ("e0", 3, "note"), ("e1", 3, "note"),
    ]


def test_masks(frame):
    df = frame(
        "customer_id long, full_name string, email string, phone string",
        (1, "Ahmed El-Sayed", "ahmed@x.eg", "+201012345678"),
        (2, "Plato", "no mail", "010 1234 5678"),
        (3, "José Núñez", None, None),
    )
    masked = views.masked_view(df.withColumn("segment_name", F.lit("x")), "customers")
    assert masked.columns == CONTRACTS["customers"].columns
    assert rows_of(masked, *df.columns) == [
        (1, "A*** E***-Sayed", "a*******@x.eg", "+20*******678"),
        (2, "Plato", "no mail", "010 1234 5678"),
        (3, "José Núñez", None, None),
    ]
    strict = views.masked_view(df, "customers", salt="s").collect()
    assert strict[1]["full_name"] == hashlib.sha256(b"sPlato").hexdigest()
    assert strict[2]["email"] is None


def test_masked_views_are_registered(spark, frame):
    drivers = frame("driver_id long, driver_name string, driver_phone string, national_id string", (1, "Ali Omar", "0101234567", "29901"))
    assert views.create_views({"drivers": drivers}) == ["DimDriver_analytical"]
    found = spark.table("DimDriver_analytical").select(*drivers.columns).collect()[0]
    assert tuple(found) == (1, "A*** O***", "01*******567", hashlib.md5(b"29901").hexdigest())


def test_conform_keeps_text(spark, frame):
    df = conform(frame("team_id string", ("7",)), CONTRACTS["teams"], as_text=True)
    assert dict(df.dtypes) == {"team_id": "string", "team_name": "string"}
    assert df.filter(F.col("team_name").isNull()).count() == 1


def test_written_tables_leave_no_shuffle_files(spark):
    from starlane.session import materialize

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = {disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())}
    made = materialize(spark.range(1000).repartition(3, "id"), "released")
    files = disk.getAllFiles()
    left = {files.apply(i).getName() for i in range(files.size())} - before
    assert made.count() == 1000 and not [name for name in left if name.startswith("shuffle_")]
