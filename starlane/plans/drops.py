"""One dropped file or dataset folder, from its path to the store.

Checks run from cheap to costly and the first failure drops the file: known
content, format, table name, emptiness, columns, types.  The ledger is written
after the load, so a failed load is tried again.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS, TableContract
from starlane.operators import gates
from starlane.plans.load import LOADED, NO_CLEAN_ROWS, Loader
from starlane.session import materialize, run_number
from starlane.sources import files
from starlane.sources.ledger import hash_files, ledger_rows, new_files


def by_contract_name(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns renamed to the contract's letter case and put in its order."""
    actual = {c.lower(): c for c in df.columns}
    return df.select([F.col(actual[c.lower()]).alias(c) for c in contract.columns])


def load_drop(loader: Loader, path: str, batch_id: str, seq: int | None = None) -> str:
    """Load the drop at ``path``; returns ``loaded`` or why it was dropped."""
    seq = run_number() if seq is None else seq
    store = loader.store
    # Written out before the load: what the ledger gets is what was there then.
    fresh = materialize(new_files(hash_files(store.spark, path), store.processed_files()), "files")
    if fresh.isEmpty():
        return "already processed"
    outcome = _load(loader, path, batch_id, seq)
    if outcome == LOADED:
        store.log_files(ledger_rows(fresh, batch_id), batch_id)
    elif outcome != "empty":
        loader.count_failed_files(files.table_name(path), batch_id, {path: outcome})
    return outcome


def _load(loader: Loader, path: str, batch_id: str, seq: int) -> str:
    reader = files.reader_for(path)
    if reader is None:
        return "unsupported format"
    named = gates.check_file_name(path)
    if not named.passed:
        return named.reason
    contract = CONTRACTS[named.table]
    raw = reader(loader.store.spark, path)
    if raw.isEmpty():
        return "empty"
    columns = gates.check_columns(raw.columns, contract)
    if not columns.passed:
        return columns.reason
    started = time.time()
    staged = loader.stage(contract.name, by_contract_name(raw, contract), batch_id)
    if gates.clean_rows(staged, contract).isEmpty():
        loader.quarantine(staged, contract, batch_id)
        loader.discard(contract.name, batch_id)
        return NO_CLEAN_ROWS
    if contract.kind == "dim":
        return loader.load_staged_dimension(contract.name, staged, batch_id, seq, started)
    return loader.load_staged(contract.name, staged, batch_id, seq, started)
