"""Data-quality measures: profiles, rates, thresholds, the long metrics form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.contracts import THRESHOLDS, TableContract
from starlane.operators.gates import null_failures

COUNTERS = [
    "total_records",
    "duplicates",
    "orphans",
    "null_records",
    "quarantined_records",
    "clean_records",
    "files_processed",
    "files_failed",
]
RATES = ["duplicate_rate", "orphan_rate", "null_rate", "file_success_rate"]


def rate(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """Percentage, or ``empty`` where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole * 100.0).otherwise(F.lit(empty))


def null_profile(df: DataFrame, contract: TableContract) -> DataFrame:
    """Count and share of NULLs per required column, all in one aggregation."""
    columns = [c for c in contract.required if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    references = {fk.column for fk in contract.foreign_keys}
    profile = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("null_count"),
                rate(F.col(c), F.col("__total")).alias("null_percentage"),
                F.lit(c in contract.primary_key).alias("is_primary_key"),
                F.lit(c in references).alias("is_foreign_key"),
                F.lit(True).alias("is_required"),
            )
            for c in columns
        ]
    )
    return counts.select(
        F.lit(contract.name).alias("table_name"), F.inline(profile)
    )


def null_summary(df: DataFrame, contract: TableContract) -> DataFrame:
    has_null = F.size(null_failures(df, contract)) > 0
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(has_null).alias("null_records"),
        F.count_if(~has_null).alias("clean_records"),
        F.when(
            F.count(F.lit(1)) > 0,
            F.count_if(has_null).cast("double") / F.count(F.lit(1)),
        )
        .otherwise(0.0)
        .alias("null_rate"),
    )


def duplicate_summary(checked: DataFrame, found: str) -> DataFrame:
    """Totals over a frame whose boolean column ``found`` marks duplicates."""
    total, hits = F.count(F.lit(1)), F.count_if(F.col(found))
    return checked.agg(
        total.alias("total_records_checked"),
        hits.alias("duplicates_found"),
        (total - hits).alias("new_records"),
        F.when(total > 0, hits.cast("double") / total).otherwise(0.0).alias("duplicate_rate"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the rates to rows of counters; an empty batch has rate 0, success 100."""
    total = F.col("total_records")
    files = F.col("files_processed")
    return counts.withColumns(
        {
            "duplicate_rate": rate(F.col("duplicates"), total),
            "orphan_rate": rate(F.col("orphans"), total),
            "null_rate": rate(F.col("null_records"), total),
            "file_success_rate": rate(files - F.col("files_failed"), files, 100.0),
        }
    )


def integrity_rate(ranked: DataFrame, missing: Column, table: str) -> DataFrame:
    total = F.count(F.lit(1))
    valid = F.count_if(~missing)
    return ranked.agg(
        F.lit(table).alias("table_name"),
        total.alias("total_records"),
        valid.alias("valid_records"),
        rate(valid, total, 100.0).alias("referential_integrity_rate"),
    )


def sla_consistency(tickets: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Share of tickets whose stored breach flags equal a recomputation."""
    flags = ["is_sla_first_breached", "is_sla_resolution_breached"]
    again = recomputed.select(key, *[F.col(f).alias(f"__{f}") for f in flags])
    same = F.lit(True)
    for f in flags:
        same = same & F.col(f).eqNullSafe(F.col(f"__{f}"))
    both = tickets.select(key, *flags).join(again, key)
    total = F.count(F.lit(1))
    return both.agg(
        F.count_if(same).alias("consistent_count"),
        total.alias("total_count"),
        rate(F.count_if(same), total, 100.0).alias("sla_consistency_rate"),
    )


def long_form(wide: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    """One row per metric: ``by`` columns, metric_name, metric_value."""
    return wide.unpivot(
        by,
        [F.col(m).cast("double").alias(m) for m in metrics],
        "metric_name",
        "metric_value",
    )


def detail_rows(profile: DataFrame) -> DataFrame:
    """The NULL shares of each table as one JSON text per table.

    A table has a fixed number of columns, so the groups are small.
    """
    entry = F.struct("column_name", "null_percentage")
    return (
        profile.groupBy("table_name")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("m"))
        .select(
            "table_name",
            F.lit("null_percentages").alias("metric_name"),
            F.to_json(F.map_from_arrays(F.array("table_name"), F.array("m"))).alias(
                "metric_details"
            ),
        )
    )


def breaches(measured: DataFrame) -> DataFrame:
    """Measurements above their threshold.

    ``measured`` has subject, metric and value columns; the threshold list is
    part of the contracts, so it is a literal in the plan.
    """
    limits = {
        "null_percentage": THRESHOLDS["max_null_percentage"],
        "duplicate_percentage": THRESHOLDS["max_duplicate_percentage"],
        "orphan_percentage": THRESHOLDS["max_orphan_percentage"],
        "duplicate_rate": THRESHOLDS["max_duplicate_rate"],
    }
    threshold = F.coalesce(
        *[F.when(F.col("metric") == name, F.lit(limit)) for name, limit in limits.items()]
    )
    return measured.withColumn("threshold", threshold).filter(
        F.col("value") > F.col("threshold")
    )


def mean_latency(batches: DataFrame) -> DataFrame:
    """Mean seconds from ``started_at`` to ``ended_at`` of each table's batches.

    Whole microseconds are summed, so the mean does not depend on their order.
    """
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at"))
    seconds = F.sum(micros).cast("double") / F.lit(1e6) / F.count(micros)
    return batches.groupBy("table_name").agg(seconds.alias("avg_processing_latency_seconds"))
