"""Tables declared in a file: a new table needs no code.

The file is one JSON object:

    {"formats": {"plate": "^[A-Z]{2}-[0-9]+$"},
     "tables": {"vans": {"kind": "dim",
                         "columns": {"van_id": "int", "plate": "string", "region_id": "int"},
                         "primary_key": ["van_id"],
                         "required": ["van_id"],
                         "foreign_keys": {"region_id": "regions.region_id"},
                         "formats": {"plate": "plate"}}}}

``required`` is the primary key unless given; ``foreign_keys`` and ``formats`` may be
left out.  Declared tables may refer to each other and to the tables known already.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from starlane.contracts import CONTRACTS, FORMAT_PATTERNS, SPARK_TYPES, ForeignKey, TableContract
from starlane.plans.drops import load_drop
from starlane.plans.load import Loader
from starlane.sources.files import literal, table_name

KINDS = ("dim", "fact")


class DeclarationError(ValueError):
    """A declaration that cannot be used; names all that is wrong with it."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class Declaration:
    """Contracts and formats of a file."""

    contracts: dict[str, TableContract]
    formats: dict[str, str] = field(default_factory=dict)


def parse(text: str) -> Declaration:
    """Contracts of a declaration's text; structure is checked here, references by ``problems``."""
    try:
        whole = json.loads(text)
    except ValueError as error:
        raise DeclarationError([f"not JSON: {error}"]) from None
    if not isinstance(whole, dict) or not isinstance(whole.get("tables"), dict):
        raise DeclarationError(["no object 'tables'"])
    wrong, contracts = [], {}
    for name, given in whole["tables"].items():
        missing = [k for k in ("kind", "columns", "primary_key") if not given.get(k)]
        unknown = sorted(set(given) - {"kind", "columns", "primary_key", "required", "foreign_keys", "formats"})
        wrong += [f"{name}: no {k}" for k in missing] + [f"{name}: unknown entry {k}" for k in unknown]
        references = given.get("foreign_keys", {})
        wrong += [f"{name}.{c}: {to!r} is not table.column" for c, to in references.items() if to.count(".") != 1]
        if missing or any(to.count(".") != 1 for to in references.values()):
            continue
        key = tuple(given["primary_key"])
        contracts[name] = TableContract(
            name=name,
            kind=given["kind"],
            types=dict(given["columns"]),
            primary_key=key,
            required=tuple(given.get("required", key)),
            foreign_keys=tuple(ForeignKey(c, *to.split(".")) for c, to in references.items()),
            formats=dict(given.get("formats", {})),
        )
    if wrong:
        raise DeclarationError(wrong)
    return Declaration(contracts, dict(whole.get("formats", {})))


def problems(declared: Declaration) -> list[str]:
    """What the tables, among each other and with those known already, get wrong."""
    every = CONTRACTS | declared.contracts
    formats = FORMAT_PATTERNS | declared.formats
    out = []
    for name, pattern in declared.formats.items():
        try:
            re.compile(pattern)
        except re.error as error:
            out.append(f"format {name}: {error}")
    for name, c in declared.contracts.items():
        if name in CONTRACTS:
            out.append(f"{name}: known already")
        if name != name.lower() or not name.isidentifier():
            out.append(f"{name}: not a lower-case name")
        if c.kind not in KINDS:
            out.append(f"{name}: kind {c.kind!r} is neither dim nor fact")
        out += [f"{name}.{k}: unknown type {t!r}" for k, t in c.types.items() if t.lower() not in SPARK_TYPES]
        named = {"primary key": c.primary_key, "required": c.required, "formats": c.formats}
        for what, columns in named.items():
            out += [f"{name}: {what} names {k!r}, which is no column" for k in columns if k not in c.types]
        out += [f"{name}.{k}: unknown format {f!r}" for k, f in c.formats.items() if f not in formats]
        for fk in c.foreign_keys:
            to = every.get(fk.table)
            if fk.column not in c.types:
                out.append(f"{name}: reference from {fk.column!r}, which is no column")
            elif to is None:
                out.append(f"{name}.{fk.column}: unknown table {fk.table!r}")
            elif fk.key not in to.types:
                out.append(f"{name}.{fk.column}: {fk.table} has no column {fk.key!r}")
            elif to.types[fk.key].lower() != c.types[fk.column].lower():
                out.append(f"{name}.{fk.column}: {c.types[fk.column]} refers to {to.types[fk.key]}")
    if not out:
        try:
            load_order(every)
        except DeclarationError as error:
            out = error.problems
    return out


def load_order(contracts: dict[str, TableContract] | None = None) -> list[str]:
    """All tables, each after those it refers to; dimensions before facts where both could go."""
    contracts = CONTRACTS if contracts is None else contracts
    waits = {n: {fk.table for fk in c.foreign_keys if fk.table != n} & set(contracts) for n, c in contracts.items()}
    out: list[str] = []
    while waits:
        free = sorted((contracts[n].kind != "dim", n) for n, on in waits.items() if not on - set(out))
        if not free:
            raise DeclarationError([f"references run in a circle: {', '.join(sorted(waits))}"])
        out.append(free[0][1])
        del waits[free[0][1]]
    return out


def read_declaration(spark: SparkSession, path: str) -> Declaration:
    """The checked declaration at ``path``, wherever Spark can read it."""
    text = "\n".join(r.value for r in spark.read.text(literal(path), wholetext=True).collect())
    declared = parse(text)
    wrong = problems(declared)
    if wrong:
        raise DeclarationError(wrong)
    return declared


@contextmanager
def declared_tables(declared: Declaration) -> Iterator[Declaration]:
    """Within this, declared tables are loaded, gated, checked and named like all others."""
    wrong = problems(declared)
    if wrong:
        raise DeclarationError(wrong)
    covered = {k: FORMAT_PATTERNS[k] for k in declared.formats if k in FORMAT_PATTERNS}
    CONTRACTS.update(declared.contracts)
    FORMAT_PATTERNS.update(declared.formats)
    try:
        yield declared
    finally:
        for name in declared.contracts:
            CONTRACTS.pop(name, None)
        for name in declared.formats:
            FORMAT_PATTERNS.pop(name, None)
        FORMAT_PATTERNS.update(covered)


def load_in_order(loader: Loader, paths: list[str], batch_id: str, seq: int) -> dict[str, str]:
    """Load drops so that each table comes after those it refers to; path and outcome of each.

    Drops of unknown tables come last and are dropped by the gate as ever.
    """
    place = {name: k for k, name in enumerate(load_order())}
    ordered = sorted(paths, key=lambda p: (place.get(table_name(p), len(place)), p))
    return {p: load_drop(loader, p, f"{batch_id}-{k}", seq + k) for k, p in enumerate(ordered)}
