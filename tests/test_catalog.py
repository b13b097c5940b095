"""Declared tables, and digests of files read range by range."""

from __future__ import annotations

import hashlib
import json
import os

import pytest

from starlane import catalog
from starlane.contracts import CONTRACTS, FORMAT_PATTERNS, target_name
from starlane.plans.load import Loader
from starlane.queries import QUERIES
from starlane.session import new_folder
from starlane.sinks import files as file_sinks
from starlane.sinks.store import Store
from starlane.sources import ledger
from tests.conftest import rows_of

VANS = {
    "formats": {"plate": "^[A-Z]{2}-[0-9]+$"},
    "tables": {
        "trips": {"kind": "fact", "columns": {"trip_id": "string", "van_id": "int", "km": "float"},
                  "primary_key": ["trip_id"], "foreign_keys": {"van_id": "vans.van_id"}},
        "vans": {"kind": "dim", "columns": {"van_id": "int", "plate": "string", "region_id": "int"},
                 "primary_key": ["van_id"], "required": ["van_id", "plate"],
                 "foreign_keys": {"region_id": "regions.region_id"}, "formats": {"plate": "plate"}},
    },
}


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_new_tables_without_code(spark, tmp_path):
    declared = catalog.read_declaration(spark, write(tmp_path / "tables.json", json.dumps(VANS, indent=1)))
    store = Store(spark, new_folder(spark, "store"))
    with catalog.declared_tables(declared):
        assert target_name("trips") == "fact_trips"
        paths = [
            write(tmp_path / "in/trips.json", '[{"trip_id": "a", "van_id": 1, "km": 2}, {"trip_id": "b", "van_id": 9, "km": 1},'
                  ' {"trip_id": "c", "van_id": 2, "km": "far"}, {"trip_id": "a", "van_id": 1, "km": 2}]'),
            write(tmp_path / "in/vans.csv", "van_id,plate,region_id\n1,AB-7,1\n2,CD-8,1\n9,nonsense,1\n"),
            write(tmp_path / "in/ships.csv", "a\n1\n"),
        ]
        outcome = catalog.load_in_order(Loader(store), paths, "d", 1)
        assert [os.path.basename(p) for p in outcome] == ["vans.csv", "trips.json", "ships.csv"]
        assert list(outcome.values()) == ["loaded", "loaded", "unknown table"]
        assert rows_of(store.fact("trips"), "trip_id", "van_id", "km") == [("a", 1, 2.0)]
        errors = dict(rows_of(store.errors(), "error_type", "event_id"))
        assert set(errors) == {"FORMAT_ERROR", "FK_MISSING", "TYPE_MISMATCH"}, errors
        assert (errors["FK_MISSING"], errors["TYPE_MISMATCH"]) == ("b", "c")
        vans = '[{"van_id": 9, "plate": "ZZ-9", "region_id": 1}, {"van_id": 1, "plate": "AB-7", "region_id": 1}]'
        again = write(tmp_path / "in2/vans.json", vans)
        assert catalog.load_in_order(Loader(store), [again], "e", 10) == {again: "loaded"}
        # A fact that waited for a declared dimension follows it.
        assert rows_of(store.fact("trips"), "trip_id") == [("a",), ("b",)]
    assert "vans" not in CONTRACTS and "plate" not in FORMAT_PATTERNS


@pytest.mark.parametrize(("change", "problem"), [
    (lambda d: d["tables"]["vans"].update(kind="cube"), "neither dim nor fact"),
    (lambda d: d["tables"]["vans"]["columns"].update(plate="varchar"), "unknown type 'varchar'"),
    (lambda d: d["tables"]["vans"].update(primary_key=["id"]), "primary key names 'id'"),
    (lambda d: d["tables"]["vans"].update(formats={"plate": "zip"}), "unknown format 'zip'"),
    (lambda d: d["tables"]["trips"].update(foreign_keys={"van_id": "cars.id"}), "unknown table 'cars'"),
    (lambda d: d["tables"]["trips"].update(foreign_keys={"van_id": "vans.no"}), "vans has no column 'no'"),
    (lambda d: d["tables"]["trips"].update(foreign_keys={"van_id": "vans.plate"}), "int refers to string"),
    (lambda d: d["tables"]["trips"].update(foreign_keys={"van_id": "vans"}), "is not table.column"),
    (lambda d: d["tables"]["vans"].update(foreign_keys={"plate": "trips.trip_id", "van_id": "trips.van_id"}), "circle: trips, vans"),
    (lambda d: d["tables"].update(orders=d["tables"]["vans"]), "orders: known already"),
    (lambda d: d["tables"]["vans"].update(notes="x"), "unknown entry notes"),
    (lambda d: d["tables"]["vans"].pop("columns"), "vans: no columns"),
    (lambda d: d.update(formats={"plate": "["}), "format plate"),
    (lambda d: d.pop("tables"), "no object 'tables'"),
])
def test_what_is_wrong_is_named(spark, tmp_path, change, problem):
    whole = json.loads(json.dumps(VANS))
    change(whole)
    with pytest.raises(catalog.DeclarationError) as error:
        catalog.read_declaration(spark, write(tmp_path / "tables.json", json.dumps(whole)))
    assert any(problem in p for p in error.value.problems), error.value.problems


def test_order_of_known_tables():
    order = catalog.load_order()
    assert sorted(order) == sorted(CONTRACTS)
    for name, contract in CONTRACTS.items():
        assert all(order.index(fk.table) < order.index(name) for fk in contract.foreign_keys if fk.table != name)


def test_digest_of_files_in_ranges(spark, tmp_path):
    texts = {"a b.csv": "x" * 10, "copy.csv": "y" * 25, "same.csv": "y" * 25, "edge.csv": "z" * 12}
    for name, text in texts.items():
        write(tmp_path / "in" / name, text)
    found = ledger.hash_files(spark, str(tmp_path / "in"), large=11, span=4)
    got = {os.path.basename(r.path).replace("%20", " "): (r.file_hash, r.file_size) for r in found.collect()}

    def want(text):
        if len(text) < 11:
            return hashlib.sha256(text.encode()).hexdigest()
        parts = [hashlib.sha256(text[k : k + 4].encode()).hexdigest() for k in range(0, len(text), 4)]
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    assert got == {name: (want(text), len(text)) for name, text in texts.items()}
    fresh = ledger.new_files(found, spark.createDataFrame([], ledger.SCHEMA))
    assert fresh.count() == 3


def test_declared_drops_are_dealt_before_they_are_written(spark, folder, monkeypatch):
    """A table in one row group must not be one task's work to write as text."""
    written = []
    monkeypatch.setattr(file_sinks, "write_csv", lambda df, path: written.append(df))
    monkeypatch.setattr(catalog, "load_in_order", lambda *_: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        QUERIES["declared_table_load"](spark, folder)
    assert len(written) == 3
    for df in written:
        assert "REBALANCE_PARTITIONS" in df._jdf.queryExecution().executedPlan().toString()
