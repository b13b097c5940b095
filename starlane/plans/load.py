"""Loading drops into the store: the same steps for batches and streams.

Dimension: gate -> enrich -> overwrite -> retry parked facts.
Fact: gate -> references -> duplicates -> enrich and compute -> append.

``batch_id`` names the partition that a load writes in every table, so a load
that died half-way is repeated as a whole and leaves the same rows.  ``seq``
is the rising number of the run.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS, TableContract, fact_tables
from starlane.functions.rows import conform
from starlane.operators import gates, quality
from starlane.operators.duplicates import first_per_key, split_stored
from starlane.operators.enrich import ENRICHMENTS
from starlane.operators.integrity import Stager, skipped_references, split_orphans
from starlane.operators.lookup import LIMITS, Limits
from starlane.plans.gold import Stages, to_gold
from starlane.session import remove_folder, write_and_read
from starlane.sinks.store import Store
from starlane.streaming.reconcile import Reconciliation, replayed_rows, retry

LOADED = "loaded"
# Rows of a batch that a staged row stands for.
COPIES = "__copies"
NO_CLEAN_ROWS = "no clean rows"


@dataclass(frozen=True)
class Loader:
    store: Store
    stages: Stages | None = None
    limits: Limits = LIMITS
    within_batch: bool = True

    def load_dimension(self, table: str, raw: DataFrame, batch_id: str, seq: int) -> str:
        """Replace a dimension and replay the facts that waited for it."""
        started = time.time()
        flagged = self.stage(table, raw, batch_id)
        return self.load_staged_dimension(table, flagged, batch_id, seq, started)

    def load_staged_dimension(
        self, table: str, flagged: DataFrame, batch_id: str, seq: int, started: float
    ) -> str:
        """``loaded``, or ``no clean rows``: then the dimension stays as it was."""
        contract = CONTRACTS[table]
        self.quarantine(flagged, contract, batch_id)
        clean = gates.clean_rows(flagged, contract)
        if clean.isEmpty():
            self._measure(flagged, contract, batch_id, {}, started, failed=1)
            self.discard(table, batch_id)
            return NO_CLEAN_ROWS
        dims = self.store.dimensions([e.dim for e in ENRICHMENTS.get(table, [])])
        gold = to_gold(clean, table, dims, batch_id, self.stages, self.limits)
        self.store.write_dimension(gold, table, seq)
        self._measure(flagged, contract, batch_id, {}, started)
        self.discard(table, batch_id)
        self.replay_all(table, seq)
        return LOADED

    def replay_all(self, table: str, seq: int) -> None:
        """Retry the facts that refer to a dimension."""
        for fact in fact_tables():
            if any(fk.table == table for fk in CONTRACTS[fact].checked_foreign_keys):
                self.replay(fact, table, seq)

    def load_fact(self, table: str, raw: DataFrame, batch_id: str, seq: int) -> str:
        started = time.time()
        flagged = self.stage(table, raw, batch_id)
        return self.load_staged(table, flagged, batch_id, seq, started)

    def stage(self, table: str, raw: DataFrame, batch_id: str) -> DataFrame:
        """Parse and check ``raw`` once and write rows and verdicts out."""
        return self._stager(table, batch_id)(gates.flag_rows(raw, CONTRACTS[table]), "flagged")

    def discard(self, owner: str, batch_id: str) -> None:
        """Remove what a finished load staged."""
        remove_folder(self.store.spark, self._staging(owner, batch_id))

    def quarantine(self, flagged: DataFrame, contract: TableContract, batch_id: str) -> None:
        bad = gates.bad_rows(flagged)
        self.store.write_errors(
            gates.error_rows(bad, contract, batch_id), f"gate_{contract.name}", batch_id
        )

    def _staging(self, owner: str, batch_id: str) -> str:
        return f"{self.store.root}/staging/{owner}/{quote(batch_id, safe='-_.')}"

    def _stager(self, owner: str, batch_id: str) -> Stager:
        """Intermediate tables of one load, in a folder of its own."""

        def stage(df: DataFrame, label: str) -> DataFrame:
            return write_and_read(df, f"{self._staging(owner, batch_id)}/{label}")

        return stage

    def load_staged(
        self,
        table: str,
        flagged: DataFrame,
        batch_id: str,
        seq: int,
        started: float,
        files: tuple[int, int] = (1, 0),
    ) -> str:
        """``loaded``, or ``no clean rows``; ``files`` counts those read and those rejected.

        Without clean rows the batch's partitions are emptied all the same.
        """
        contract = CONTRACTS[table]
        self.quarantine(flagged, contract, batch_id)
        clean = conform(gates.clean_rows(flagged, contract), contract)
        outcome = NO_CLEAN_ROWS if clean.isEmpty() else LOADED
        counts = self._load_clean(clean, contract, batch_id, seq, self._stager(table, batch_id))
        self._measure(flagged, contract, batch_id, counts, started, *files)
        self.discard(table, batch_id)
        return outcome

    def replay(self, fact: str, dim_name: str, seq: int) -> None:
        """Move the waiting events of ``fact`` one step; resolved rows load again.

        They re-enter before the reference check, so a second missing
        reference parks them anew.  The transitions are logged last: if the run
        dies before, the next one finds the same events waiting.
        """
        contract = CONTRACTS[fact]
        waiting = Reconciliation(self.store, contract)
        dim = self.store.dimensions([dim_name])[dim_name]
        batch_id = f"replay-{dim_name}-{seq}"
        owner = f"{fact}-after-{dim_name}"
        stage = self._stager(owner, batch_id)
        moved = stage(
            retry(waiting.states(), dim_name, dim, seq, limits=self.limits), "moved"
        )
        if not moved.isEmpty():
            rows = replayed_rows(waiting.parked(), moved, self.limits)
            counts = self._load_clean(rows, contract, batch_id, seq, stage)
            self._count_replay(contract, batch_id, counts)
            waiting.append_log(moved, f"{batch_id}-retry")
            waiting.fold_if_due()
        self.discard(owner, batch_id)

    def _count_replay(
        self, contract: TableContract, batch_id: str, counts: dict[str, int]
    ) -> None:
        """Counters of the rows that a retry brought back."""
        wide = self.store.spark.range(1).select(
            F.lit(contract.name).alias("table_name"),
            *[F.lit(n).cast("bigint").alias(k) for k, n in counts.items()],
        )
        rows = quality.long_form(wide, list(counts), ["table_name"])
        self.store.write_metrics(
            rows.withColumn("metric_details", F.lit("replay")), f"{contract.name}-{batch_id}"
        )

    def _load_clean(
        self,
        clean: DataFrame,
        contract: TableContract,
        batch_id: str,
        seq: int,
        stage: Stager,
    ) -> dict[str, int]:
        """Check, deduplicate and write ``clean``; rows are counted as they are written."""
        dims = self.store.dimensions()
        sides = split_orphans(clean, contract, dims, self.limits, True, stage)
        keys = list(contract.primary_key)
        reference = {"error_column": F.col("fk_column"), "fk_table": F.col("dim_name")}
        orphans = self.store.write_errors(
            gates.error_rows(
                sides.charged,
                contract,
                batch_id,
                F.lit("FK_MISSING"),
                columns=contract.columns,
                **reference,
            ),
            f"references_{contract.name}",
            batch_id,
        )
        Reconciliation(self.store, contract).register(sides.charged, batch_id, seq)
        copies = F.lit(1).cast("bigint")
        fresh = sides.clean.withColumn(COPIES, copies)
        if self.within_batch:
            # Staged by the tasks that read the drop, a part each.
            fresh = first_per_key(sides.clean, keys, COPIES, deal=False)
        kept = Observation()
        total = F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows")
        # Written once: the sizing, the check against history and the gold table read it.
        fresh = stage(fresh.observe(kept, total), "fresh").drop(COPIES)
        earlier = self.store.fact_table(contract.name).known_keys(fresh, keys, batch_id)
        if earlier is not None:
            fresh = split_stored(fresh, earlier, keys, self.limits).new
        gold = to_gold(fresh, contract.name, dims, batch_id, self.stages, self.limits)
        written = self.store.write_fact(gold, contract.name, batch_id)
        return {
            "orphans": orphans,
            "clean_records": written,
            "duplicates": kept.get["rows"] - written,
            "skipped_references": len(skipped_references(contract, dims)),
        }

    def count_failed_files(self, table: str, batch_id: str, reasons: dict[str, str]) -> None:
        """Put dropped files on record: each one's path and why."""
        rows = self.store.spark.createDataFrame(
            [(table, "files_failed", 1.0, f"{path}: {why}") for path, why in sorted(reasons.items())],
            "table_name string, metric_name string, metric_value double, metric_details string",
        )
        self.store.write_metrics(rows, f"{table}-{batch_id}-failed")

    def _measure(
        self,
        flagged: DataFrame,
        contract: TableContract,
        batch_id: str,
        counts: dict[str, int],
        started: float,
        read: int = 1,
        failed: int = 0,
    ) -> None:
        """Write the batch's counters, rates, NULL shares, and its time from the first read on."""
        kind = F.col(gates.ERROR_TYPE)
        good = F.count_if(kind.isNull())
        wide = flagged.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.lit(counts.get("duplicates", 0)).alias("duplicates"),
            F.lit(counts.get("orphans", 0)).alias("orphans"),
            F.count_if(kind == "NULL_REQUIRED_COLUMN").alias("null_records"),
            (F.count_if(kind.isNotNull()) + counts.get("orphans", 0)).alias(
                "quarantined_records"
            ),
            (F.lit(counts["clean_records"]) if counts else good).alias("clean_records"),
            F.lit(read).alias("files_processed"),
            F.lit(failed).alias("files_failed"),
        )
        extra = {"processing_latency_seconds": F.lit(time.time() - started)}
        if counts:
            extra["skipped_references"] = F.lit(counts["skipped_references"])
        wide = quality.with_rates(wide).withColumns(extra)
        scalars = quality.long_form(
            wide.withColumn("table_name", F.lit(contract.name)),
            quality.COUNTERS + quality.RATES + list(extra),
            ["table_name"],
        ).withColumn("metric_details", F.lit(None).cast("string"))
        details = quality.detail_rows(quality.null_profile(flagged, contract)).withColumn(
            "metric_value", F.lit(None).cast("double")
        )
        self.store.write_metrics(
            scalars.unionByName(details), f"{contract.name}-{batch_id}"
        )
