"""Audit columns and the computed columns of the two measured facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.contracts import DEFAULT_SLA_FIRST_MIN, DEFAULT_SLA_RESOLVE_MIN
from starlane.functions.times import date_id, minutes_between


def audit(df: DataFrame, batch_id: str) -> DataFrame:
    """Ingestion time and batch of every row, one value per batch."""
    return df.withColumns(
        {
            "ingested_at": F.current_timestamp().cast("timestamp_ntz"),
            "batch_id": F.lit(batch_id),
        }
    )


def order_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "net_revenue": F.col("order_amount")
            + F.col("delivery_fee")
            - F.col("discount_amount"),
            "delivery_duration_min": minutes_between(
                F.col("order_created_at"), F.col("delivered_at")
            ),
            "order_date_id": date_id(F.col("order_created_at")),
            "delivered_date_id": date_id(F.col("delivered_at")),
        }
    )


def ticket_metrics(df: DataFrame) -> DataFrame:
    """Response times, breach flags, revenue impact and date keys.

    The default limits apply only where the table has no limit column at all.
    A NULL limit (priority without a match) or a missing time is not a breach.
    """
    first_limit = (
        F.col("sla_first_response_min")
        if "sla_first_response_min" in df.columns
        else F.lit(DEFAULT_SLA_FIRST_MIN)
    )
    resolve_limit = (
        F.col("sla_resolution_min")
        if "sla_resolution_min" in df.columns
        else F.lit(DEFAULT_SLA_RESOLVE_MIN)
    )
    first = minutes_between(F.col("created_at"), F.col("first_response_at"))
    resolve = minutes_between(F.col("created_at"), F.col("resolved_at"))
    return df.withColumns(
        {
            "first_response_min": first,
            "resolution_min": resolve,
            "is_sla_first_breached": F.coalesce(first > first_limit, F.lit(False)),
            "is_sla_resolution_breached": F.coalesce(
                resolve > resolve_limit, F.lit(False)
            ),
            "is_reopened": F.coalesce(F.col("status") == "Reopened", F.lit(False)),
            "revenue_impact": F.coalesce(F.col("refund_amount"), F.lit(0.0)),
            "created_date_id": date_id(F.col("created_at")),
            "first_response_date_id": date_id(F.col("first_response_at")),
            "resolved_date_id": date_id(F.col("resolved_at")),
        }
    )


METRICS = {"orders": order_metrics, "tickets": ticket_metrics}


def metrics(df: DataFrame, table: str) -> DataFrame:
    """Computed columns of ``table``; tables without any pass through."""
    return METRICS[table](df) if table in METRICS else df
