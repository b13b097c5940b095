"""The table store: versioned dimensions, batch-partitioned facts and logs.

Everything is parquet under one root.  A dimension load writes a new version
and then names it in the version list, so readers never see half of it.  A fact's
batch becomes visible by one manifest row (see ``facts``).  Logs are partitioned by
batch and a batch overwrites its own partition.  A batch replaces what it held, also
by nothing, so a repeated batch leaves what its last run found.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.contracts import CONTRACTS, target_name
from starlane.functions.casts import without_nan
from starlane.sinks.facts import FactTable
from starlane.sources import ledger
from starlane.session import empty_frame, read_if_exists

_VERSIONS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)

ERRORS = T.StructType(
    [
        T.StructField("error_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_column", T.StringType()),
        T.StructField("fk_table", T.StringType()),
        T.StructField("retryable", T.BooleanType()),
        T.StructField("stage", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("metric_details", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def replace_batch(self, df: DataFrame, name: str, **owned: str) -> int:
        """Make ``df`` all that the partition with the values ``owned`` holds, even if it is empty.

        Returns its number of rows, counted as they are written.
        """
        folder = [f"{column}={quote(value, safe=' -_.')}" for column, value in owned.items()]
        counted = Observation()
        rows = df.drop(*owned).observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").parquet(self._path(name, *folder))
        return counted.get["rows"]

    def write_dimension(self, df: DataFrame, table: str, seq: int) -> None:
        """Full replacement: version ``seq`` becomes what readers get."""
        path = self._path(target_name(table), f"v{seq}")
        without_nan(df).write.mode("overwrite").parquet(path)
        self.spark.range(1).select(
            F.lit(table).alias("table_name"),
            F.lit(seq).cast("bigint").alias("seq"),
            F.lit(path).alias("path"),
        ).write.mode("append").parquet(self._path("versions"))

    def dimensions(self, tables: list[str] | None = None) -> dict[str, DataFrame]:
        """Current version of each loaded dimension; one short list is read."""
        latest = (
            read_if_exists(self.spark, self._path("versions"), _VERSIONS)
            .groupBy("table_name")
            .agg(F.max_by("path", "seq").alias("path"))
        )
        return {
            r["table_name"]: self.spark.read.parquet(r["path"])
            for r in latest.collect()
            if tables is None or r["table_name"] in tables
        }

    def fact_table(self, table: str) -> FactTable:
        return FactTable(self.spark, self._path(target_name(table)))

    def write_fact(self, gold: DataFrame, table: str, batch_id: str) -> int:
        """Make ``gold`` what a batch holds, in one step for readers; returns its number of rows."""
        contract = CONTRACTS.get(table)
        keys = contract.primary_key if contract else ()
        return self.fact_table(table).replace(without_nan(gold), batch_id, keys)

    def fact(self, table: str) -> DataFrame | None:
        """All loaded rows of a fact, None before its first load."""
        return self.fact_table(table).read()

    def write_errors(self, rows: DataFrame, stage: str, batch_id: str) -> int:
        """Quarantine ``rows`` and return their number; ``stage`` keeps one batch's writers apart."""
        stamped = rows.withColumns(
            {
                "error_id": F.uuid(),
                "created_at": F.current_timestamp().cast("timestamp_ntz"),
                "stage": F.lit(stage),
            }
        )
        return self.replace_batch(
            stamped.select(ERRORS.fieldNames()),
            "streaming_pipeline_errors",
            stage=stage,
            batch_id=batch_id,
        )

    def errors(self) -> DataFrame:
        return read_if_exists(self.spark, self._path("streaming_pipeline_errors"), ERRORS)

    def write_metrics(self, rows: DataFrame, batch_id: str) -> None:
        stamped = rows.withColumn(
            "created_at", F.current_timestamp().cast("timestamp_ntz")
        )
        columns = [c for c in METRICS.fieldNames() if c != "batch_id"]
        self.replace_batch(stamped.select(columns), "quality_metrics", batch_id=batch_id)

    def metrics(self) -> DataFrame:
        return read_if_exists(self.spark, self._path("quality_metrics"), METRICS)

    def processed_files(self) -> DataFrame:
        return read_if_exists(self.spark, self._path("processed_files"), ledger.SCHEMA)

    def log_files(self, rows: DataFrame, batch_id: str) -> None:
        self.replace_batch(rows, "processed_files", batch_id=batch_id)

    def clear_files(self) -> int:
        """Forget all processed files; returns how many there were."""
        cleared = self.processed_files().count()
        empty_frame(self.spark, ledger.SCHEMA).write.mode("overwrite").partitionBy(
            "batch_id"
        ).parquet(self._path("processed_files"))
        return cleared
