"""The ten KPI reports over the gold facts.

Where a report joins a dimension, the fact is first counted per foreign key:
the counting combines before the shuffle and the join sees one row per key, so
a key that holds a third of all tickets costs no more than any other.  Left
joins keep tickets without a match under a NULL group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.operators.lookup import unique_rows


def _percent(condition: Column) -> Column:
    share = F.count_if(condition).cast("double") * 100.0 / F.count(F.lit(1))
    return F.round(share, 2)


def money(value: Column) -> Column:
    """Exact sum, independent of the order of rows; amounts keep eight decimals."""
    return F.sum(value.cast("decimal(28,8)")).cast("double")


def total_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.agg(F.count(F.lit(1)).alias("total_tickets"))


def sla_breach_rate(tickets: DataFrame) -> DataFrame:
    return tickets.agg(
        _percent(F.col("is_sla_first_breached")).alias("first_response_breach_rate"),
        _percent(F.col("is_sla_resolution_breached")).alias("resolution_breach_rate"),
    )


def average_times(tickets: DataFrame) -> DataFrame:
    return tickets.agg(
        F.round(F.avg("first_response_min"), 2).alias("avg_first_response_time_min"),
        F.round(F.avg("resolution_min"), 2).alias("avg_resolution_time_min"),
    )


def reopen_rate(tickets: DataFrame) -> DataFrame:
    return tickets.agg(_percent(F.col("is_reopened")).alias("reopen_rate_pct"))


def refund_and_revenue(tickets: DataFrame) -> DataFrame:
    return tickets.agg(
        money(F.col("refund_amount")).alias("total_refund_amount"),
        money(F.col("revenue_impact")).alias("total_revenue_impact"),
    )


def _count_per(tickets: DataFrame, key: str) -> DataFrame:
    return tickets.groupBy(key).agg(F.count("ticket_id").alias("ticket_count"))


def _regroup(counts: DataFrame, names: list[str]) -> DataFrame:
    return (
        counts.groupBy(*names)
        .agg(F.sum("ticket_count").alias("ticket_count"))
        .orderBy(F.desc("ticket_count"), *names)
    )


def tickets_by_city_region(
    tickets: DataFrame, orders: DataFrame, regions: DataFrame
) -> DataFrame:
    """Tickets carry no region; it is taken from their order."""
    per_region = (
        _count_per(tickets, "order_id")
        .join(orders.select("order_id", "region_id"), "order_id", "left")
        .groupBy("region_id")
        .agg(F.sum("ticket_count").alias("ticket_count"))
    )
    named = unique_rows(
        regions.select("region_id", "city_name", "region_name"), ["region_id"]
    )
    return _regroup(
        per_region.join(named, "region_id", "left"), ["city_name", "region_name"]
    )


def tickets_by_restaurant(tickets: DataFrame, restaurants: DataFrame) -> DataFrame:
    names = unique_rows(
        restaurants.select("restaurant_id", "restaurant_name"), ["restaurant_id"]
    )
    counts = _count_per(tickets, "restaurant_id").join(names, "restaurant_id", "left")
    return _regroup(counts, ["restaurant_name"])


def tickets_by_driver(tickets: DataFrame, drivers: DataFrame) -> DataFrame:
    names = unique_rows(drivers.select("driver_id", "driver_name"), ["driver_id"])
    counts = _count_per(tickets, "driver_id").join(names, "driver_id", "left")
    return _regroup(counts, ["driver_name"])


def complaint_rate(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Tickets per thousand orders, both counted in one aggregation."""
    both = tickets.select(F.lit(1).alias("t"), F.lit(0).alias("o")).unionAll(
        orders.select(F.lit(0).alias("t"), F.lit(1).alias("o"))
    )
    tickets_n, orders_n = F.sum("t").cast("double"), F.sum("o")
    return both.agg(
        F.when(orders_n > 0, tickets_n * 1000.0 / orders_n).alias(
            "complaint_rate_per_1000_orders"
        )
    )


def loss_by_reason_category(tickets: DataFrame, reasons: DataFrame) -> DataFrame:
    per_reason = tickets.groupBy("reason_id").agg(
        F.sum(F.col("revenue_impact").cast("decimal(28,8)")).alias("loss")
    )
    names = unique_rows(
        reasons.select("reason_id", "reason_category_name"), ["reason_id"]
    )
    return (
        per_reason.join(names, "reason_id", "left")
        .groupBy("reason_category_name")
        .agg(F.sum("loss").cast("double").alias("total_loss"))
        .orderBy(F.desc("total_loss"), "reason_category_name")
    )
