"""Parked orphan facts and the states of their retries.

Nothing is updated in place.  Parked rows are appended once with all their
columns; a narrow log gets one row per event and transition, and the latest row
per event is its state.  Transitions carry the number of the run that made
them, so one run moves an event at most one step however often it is repeated.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.contracts import CONTRACTS, MAX_RETRIES, TableContract
from starlane.operators.lookup import LIMITS, Limits, lookup_join
from starlane.session import read_if_exists, remove_folder, run_number
from starlane.sinks.store import Store

OPEN_STATES = ["PENDING", "RETRYING"]

LOG = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("fk_column", T.StringType()),
        T.StructField("fk_value", T.StringType()),
        T.StructField("dim_name", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

_STATE = ["seq", "step", "fk_column", "fk_value", "dim_name", "retry_count", "status"]

FOLDS = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)

# The log is folded when its later batches hold a row for so many rows of the folded states.
FOLD_RATIO = 4


def parked_schema(contract: TableContract) -> T.StructType:
    return T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("fk_column", T.StringType()),
            T.StructField("row", contract.schema),
            T.StructField("batch_id", T.StringType()),
        ]
    )


def _event_id(contract: TableContract):
    return F.col(contract.primary_key[0]).cast("string")


def parked_rows(charged: DataFrame, contract: TableContract, batch_id: str) -> DataFrame:
    """Charged orphans with their whole row as typed columns."""
    return charged.select(
        _event_id(contract).alias("event_id"),
        "fk_column",
        F.struct(*contract.columns).alias("row"),
        F.lit(batch_id).alias("batch_id"),
    )


def registrations(charged: DataFrame, contract: TableContract, seq: int) -> DataFrame:
    """One PENDING row per event; copies of an event combine before the shuffle."""
    reference = F.struct("fk_column", "fk_value", "dim_name")
    return (
        charged.groupBy(_event_id(contract).alias("event_id"))
        .agg(F.min(reference).alias("r"))
        .select(
            "event_id",
            "r.*",
            F.lit(0).alias("retry_count"),
            F.lit("PENDING").alias("status"),
            F.lit(seq).cast("bigint").alias("seq"),
            F.lit(1).alias("step"),
        )
    )


def latest(log: DataFrame) -> DataFrame:
    """State of each event.

    A maximum instead of a window: it combines before the shuffle, so a long
    history of one event stays cheap.
    """
    return log.groupBy("event_id").agg(F.max(F.struct(*_STATE)).alias("s")).select("event_id", "s.*")


def retryable(states: DataFrame, dim_name: str | None = None) -> DataFrame:
    """Events still waiting, for one dimension or for any; NULL references never retry."""
    waiting = states.filter(F.col("status").isin(OPEN_STATES))
    if dim_name is None:
        return waiting
    return waiting.filter((F.col("dim_name") == dim_name) & F.col("fk_value").isNotNull())


def retry(
    states: DataFrame,
    dim_name: str,
    dim: DataFrame,
    seq: int,
    max_retries: int = MAX_RETRIES,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Next state of each waiting event, now that ``dim`` has been loaded.

    Events already moved by run ``seq`` are left alone.
    """
    waiting = retryable(states, dim_name).filter(F.col("seq") < seq)
    key = CONTRACTS[dim_name].primary_key[0]
    known = (
        dim.select(F.col(key).cast("string").alias("fk_value"))
        .dropna()
        .distinct()
        .withColumn("__found", F.lit(True))
    )
    found = F.col("__found").isNotNull()
    tried = F.col("retry_count") + 1
    return lookup_join(waiting, known, ["fk_value"], "left", limits).select(
        "event_id",
        "fk_column",
        "fk_value",
        "dim_name",
        F.when(found, F.col("retry_count")).otherwise(tried).alias("retry_count"),
        F.when(found, "RESOLVED")
        .when(tried >= max_retries, "DEAD")
        .otherwise("RETRYING")
        .alias("status"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(0).alias("step"),
    )


def replayed_rows(parked: DataFrame, moved: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Whole rows of the events that a run resolved."""
    resolved = moved.filter(F.col("status") == "RESOLVED").select("event_id", "fk_column")
    return lookup_join(
        parked, resolved, ["event_id", "fk_column"], "left_semi", limits
    ).select("row.*")


@dataclass(frozen=True)
class Reconciliation:
    """Parked rows and log of one fact table in a store."""

    store: Store
    contract: TableContract

    @property
    def _parked_name(self) -> str:
        return f"parked_{self.contract.name}"

    @property
    def _log_name(self) -> str:
        return f"reconciliation_{self.contract.name}"

    def parked(self) -> DataFrame:
        return read_if_exists(
            self.store.spark,
            f"{self.store.root}/{self._parked_name}",
            parked_schema(self.contract),
        )

    def log(self) -> DataFrame:
        return read_if_exists(
            self.store.spark, f"{self.store.root}/{self._log_name}", LOG
        )

    @property
    def _folds(self) -> str:
        return f"{self.store.root}/{self._log_name}_folds"

    def _fold(self) -> Row | None:
        """The last entry of the list of folds, None if there is none or it was withdrawn."""
        last = read_if_exists(self.store.spark, f"{self._folds}/list", FOLDS).agg(
            F.max(F.struct(*FOLDS.fieldNames())).alias("f")
        )
        fold = last.first()["f"]
        return fold if fold and fold["path"] else None

    def _point_to(self, path: str | None, n_rows: int) -> None:
        """Readers take the states at ``path`` from now on, or the whole log."""
        listed = read_if_exists(self.store.spark, f"{self._folds}/list", FOLDS)
        number = max(run_number(), (listed.agg(F.max("number")).first()[0] or 0) + 1)
        entry = self.store.spark.createDataFrame([(number, path, n_rows)], FOLDS)
        entry.coalesce(1).write.mode("append").parquet(f"{self._folds}/list")

    def _folded(self, fold: Row) -> DataFrame:
        return self.store.spark.read.schema("batch_id string").parquet(f"{fold['path']}/batches")

    def _sides(self, fold: Row | None) -> tuple[DataFrame | None, DataFrame]:
        """The folded states and the log's other batches."""
        log = self.log()
        if fold is None:
            return None, log
        # Names of batches, as many as the log has folders.
        names = [r["batch_id"] for r in self._folded(fold).collect()]
        states = self.store.spark.read.schema(
            T.StructType([f for f in LOG.fields if f.name in ["event_id", *_STATE]])
        ).parquet(f"{fold['path']}/states")
        return states, log.where(~F.col("batch_id").isin(names)) if names else log

    def states(self) -> DataFrame:
        """State of each event: the folded states, and of the log only the batches that came later."""
        folded, later = self._sides(self._fold())
        if folded is None:
            return latest(later)
        return latest(folded.unionByName(later.select(folded.columns)))

    def fold(self) -> None:
        """Fold the whole log into one table of states.

        States and the names of their batches are written beside; one row in the list of
        folds makes them what readers take.  A fold that dies before leaves nothing to see.
        A table has one writer at a time.
        """
        earlier = self._fold()
        folded, later = self._sides(earlier)
        path = f"{self._folds}/{uuid.uuid4().hex}"
        columns = ["event_id", *_STATE]
        rows = later.select(columns)
        if folded is not None:
            rows = rows.unionByName(folded)
        counted = Observation()
        states = latest(rows).observe(counted, F.count(F.lit(1)).alias("rows"))
        states.write.parquet(f"{path}/states")
        names = later.select("batch_id").distinct()
        if folded is not None:
            names = names.unionByName(self._folded(earlier))
        names.coalesce(1).write.parquet(f"{path}/batches")
        self._point_to(path, counted.get["rows"])

    def fold_if_due(self) -> bool:
        """Fold once the later batches hold a fair share of the folded rows, so that folding
        costs a constant number of writes for each logged row."""
        fold = self._fold()
        later = self._sides(fold)[1].count()
        due = later > 0 and (fold is None or later * FOLD_RATIO >= fold["n_rows"])
        if due:
            self.fold()
        return due

    def expire_folds(self) -> int:
        """Remove the states that earlier folds left; readers that still use them fail."""
        spark, current = self.store.spark, self._fold()
        paths = read_if_exists(spark, f"{self._folds}/list", FOLDS).where("path is not null").select("path").distinct()
        old = [r["path"] for r in paths.collect() if current is None or r["path"] != current["path"]]
        return sum(remove_folder(spark, path) for path in old)

    def append_log(self, rows: DataFrame, batch_id: str) -> None:
        """Write a batch of the log; a fold that holds an earlier run of it is withdrawn before."""
        fold = self._fold()
        if fold is not None and not self._folded(fold).where(F.col("batch_id") == batch_id).isEmpty():
            self._point_to(None, 0)
        stamped = rows.withColumns(
            {
                "updated_at": F.current_timestamp().cast("timestamp_ntz"),
                "batch_id": F.lit(batch_id),
            }
        )
        self.store.replace_batch(
            stamped.select(LOG.fieldNames()), self._log_name, batch_id=batch_id
        )

    def register(self, charged: DataFrame, batch_id: str, seq: int) -> None:
        self.store.replace_batch(
            parked_rows(charged, self.contract, batch_id), self._parked_name, batch_id=batch_id
        )
        self.append_log(registrations(charged, self.contract, seq), batch_id)
