"""File streams of facts: each micro-batch runs the batch load.

The stream delivers the paths of new files; the files themselves go through the
gates of a drop: format, table name, columns, then the rows' checks.  The
checkpoint remembers file paths; the ledger remembers file contents, so a
renamed copy is skipped too.  A micro-batch names its partitions after its
number: repeated after a crash, it replaces what it had written.  The ledger is
written after the load, so a file whose load failed is read again.
"""

from __future__ import annotations

import re
import time
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from starlane.contracts import CONTRACTS
from starlane.functions.rows import conform
from starlane.operators import gates
from starlane.plans.drops import by_contract_name
from starlane.plans.load import Loader
from starlane.session import empty_frame, run_number, write_and_read
from starlane.sources import files
from starlane.sources.ledger import hash_files, ledger_rows, new_files
from starlane.sources.ranges import file_state

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def new_paths(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """A stream of the paths of new files under ``path``; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select("path")
    )


def settled_paths(spark: SparkSession, path: str, max_files: int, settle: float) -> DataFrame:
    """A stream of the paths of new files, each released once it has stayed the same for ``settle`` seconds.

    A file waits as keyed state with a timer.  When the timer ends, size and time of change are
    looked up by an executor: unchanged files are released, others wait anew, removed ones are
    forgotten.  State outlives restarts in the checkpoint.
    """
    milliseconds = max(1, round(settle * 1000))

    def release(
        key: tuple[str], rows: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = file_state(key[0])
        if now is None:
            if state.exists:
                state.remove()
        elif state.hasTimedOut and state.get == now:
            state.remove()
            yield pd.DataFrame({"path": [key[0]]})
        else:
            state.update(now)
            state.setTimeoutDuration(milliseconds)

    return (
        new_paths(spark, path, max_files)
        .groupBy("path")
        .applyInPandasWithState(
            release, "path string", "length long, changed long", "append", "ProcessingTimeTimeout"
        )
    )


def dataset_of(path: str) -> str:
    """The dropped file, or the folder ``t.json`` of part files that a file belongs to."""
    found = re.match(r"(?i)(.*?/[^/]+\.(?:csv|json))(?:/|$)", path)
    return found.group(1) if found else path


def gate_files(
    spark: SparkSession, table: str, paths: list[str], fmt: str
) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """Accepted files by the names in their header, and why each other dataset is rejected.

    Part files of one dataset are judged by all their names together.
    """
    rejected, members = {}, defaultdict(list)
    for path in paths:
        members[dataset_of(path)].append(path)
    for dataset in list(members):
        verdict = gates.check_file_name(dataset)
        if not dataset.lower().endswith(f".{fmt}"):
            rejected[dataset] = "unsupported format"
        elif not verdict.passed or verdict.table != table:
            rejected[dataset] = verdict.reason or f"a file of {verdict.table}"
        if dataset in rejected:
            del members[dataset]
    wanted = [p for own in members.values() for p in own]
    names = {}
    if wanted:
        # At most max_files short lists of names.
        for row in files.header_names(spark, wanted, fmt).collect():
            names[plain(unquote(row.path))] = tuple(row.names)
    accepted = defaultdict(list)
    for dataset, own in members.items():
        headers = [names.get(plain(p), ()) for p in own]
        union = list(dict.fromkeys(n for header in headers for n in header))
        if not union:
            continue
        verdict = gates.check_columns(union, CONTRACTS[table])
        if not verdict.passed:
            rejected[dataset] = verdict.reason
            continue
        for path, header in zip(own, headers):
            accepted[header if fmt == "csv" else tuple(union)].append(path)
    return {h: own for h, own in accepted.items() if h}, rejected


def read_files(
    spark: SparkSession, table: str, accepted: dict[tuple[str, ...], list[str]], fmt: str
) -> DataFrame:
    """Rows of all accepted files as text, columns by name."""
    contract = CONTRACTS[table]
    reader = files.read_csv if fmt == "csv" else files.read_json
    parts = [
        by_contract_name(reader(spark, [files.literal(p) for p in own], list(header)), contract)
        for header, own in accepted.items()
    ]
    if not parts:
        return empty_frame(spark, contract.text_schema)
    return conform(reduce(DataFrame.unionByName, parts), contract, as_text=True)


def ingest(
    loader: Loader,
    table: str,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    next_seq: Callable[[], int] = run_number,
    max_files: int = 1000,
    once: bool = True,
    interval: str = "1 minute",
    settle: float | None = None,
) -> StreamingQuery:
    """Start the stream of one fact table.

    ``once`` stops when all present files are loaded.  The paths of one
    micro-batch, at most ``max_files``, pass through the driver; rows do not.  With
    ``settle``, a file is loaded when it has not changed for so many seconds; that takes a
    stream that keeps running, and a micro-batch may hold files found by several.
    """
    if settle is not None and once:
        raise ValueError("a stream that stops at once cannot wait for files to settle")
    store = loader.store
    stream_id = f"stream-{table}"

    def load(rows: DataFrame, number: int) -> None:
        started = time.time()
        batch_id = f"{stream_id}-{number}"
        paths = sorted(r.path for r in rows.distinct().collect())
        if not paths:
            return
        accepted, rejected = gate_files(store.spark, table, paths, fmt)
        loader.count_failed_files(table, batch_id, rejected)
        held = [p for own in accepted.values() for p in own]
        fresh = None
        if held:
            others = store.processed_files().filter(F.col("batch_id") != batch_id)
            fresh = write_and_read(
                new_files(hash_files(store.spark, [files.literal(p) for p in held]), others),
                f"{store.root}/staging/{table}/{batch_id}-files",
            )
            kept = {plain(r["path"]) for r in fresh.select("path").collect()}
            accepted = {h: [p for p in own if plain(p) in kept] for h, own in accepted.items()}
            accepted = {h: own for h, own in accepted.items() if own}
        wanted = read_files(store.spark, table, accepted, fmt)
        staged = loader.stage(table, wanted, batch_id)
        counted = (sum(map(len, accepted.values())), len(rejected))
        loader.load_staged(table, staged, batch_id, next_seq(), started, counted)
        if fresh is not None:
            store.log_files(ledger_rows(fresh, batch_id), batch_id)
            loader.discard(table, f"{batch_id}-files")

    stream = new_paths(store.spark, path, max_files)
    if settle is not None:
        stream = settled_paths(store.spark, path, max_files, settle)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def plain(path: str) -> str:
    """Path without the slashes that tell URI spellings apart."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if rest.startswith("/") else path
