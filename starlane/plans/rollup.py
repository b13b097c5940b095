"""KPI sums kept beside the fact of tickets, batch by batch, and the ten reports from them.

A refresh reads only the ticket batches whose stored version it has not summed yet; a
replaced batch replaces its sums.  The sums of a batch carry the version of the batch they
come from, so a refresh that died, or a batch that changed meanwhile, is caught up by
the next one.  Reports merge the sums on read; their size follows the number of batches
and dimension keys, not of tickets.

Tickets carry no region, it is taken from their order.  Tickets whose order is not stored
yet are kept under the order and find their region on read; the next refresh that
sees new orders sums their batches anew.  A replaced order batch may move
tickets to other regions: then all batches are summed anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starlane.operators.lookup import unique_rows
from starlane.sinks.facts import FactTable
from starlane.sinks.store import Store

_MONEY = "decimal(28,8)"
_KEYS = {"restaurant": "restaurant_id", "driver": "driver_id", "reason": "reason_id"}


def _sum(name: str) -> Column:
    return F.sum(F.col(name).cast(_MONEY))


# Kept sums: rows, flags that are counted, values whose sums and numbers are kept, amounts.
_FLAGS = {
    "first_breached": "is_sla_first_breached",
    "resolution_breached": "is_sla_resolution_breached",
    "reopened": "is_reopened",
}
_TIMES = {"first": "first_response_min", "resolution": "resolution_min"}
_AMOUNTS = {"refund": "refund_amount", "loss": "revenue_impact"}
_SUMS = [
    "tickets", "ids", *_FLAGS, *[f"{t}_total" for t in _TIMES], *[f"{t}_known" for t in _TIMES], *_AMOUNTS,
]


def _from_tickets() -> list[Column]:
    """The kept sums, in the order of ``_SUMS``."""
    values = [
        F.count(F.lit(1)), F.count("ticket_id"), *[F.count_if(c) for c in _FLAGS.values()],
        *[_sum(c) for c in _TIMES.values()], *[F.count(c) for c in _TIMES.values()],
        *[_sum(c) for c in _AMOUNTS.values()],
    ]
    return [value.alias(name) for name, value in zip(_SUMS, values, strict=True)]


def partials(tickets: DataFrame, orders: DataFrame | None) -> DataFrame:
    """One row for each batch, part ("all", a dimension, or "order") and key, with its sums.

    Keys are texts; NULL is a key of its own.
    """
    sets = [["batch_id"], *[["batch_id", key] for key in _KEYS.values()]]
    columns = [F.col("batch_id"), *[F.col(key) for key in _KEYS.values()]]
    grouped = tickets.groupingSets([[F.col(c) for c in own] for own in sets], *columns).agg(
        *_from_tickets(),
        *[F.grouping(key).alias(f"no_{part}") for part, key in _KEYS.items()],
    )
    part, key = F.lit("all"), F.lit(None).cast("string")
    for name, column in _KEYS.items():
        part = F.when(F.col(f"no_{name}") == 0, name).otherwise(part)
        key = F.when(F.col(f"no_{name}") == 0, F.col(column).cast("string")).otherwise(key)
    sums = grouped.select("batch_id", part.alias("part"), key.alias("key"), *_SUMS)
    per_order = tickets.groupBy("batch_id", "order_id").agg(F.count("ticket_id").alias("ids"))
    if orders is None:
        placed = per_order.withColumns({"region_id": F.lit(None), "stored": F.lit(None)})
    else:
        known = orders.select("order_id", "region_id", F.lit(True).alias("stored"))
        placed = per_order.join(known, "order_id", "left")
    # A ticket without an order never gets a region.
    is_placed = F.col("stored").isNotNull() | F.col("order_id").isNull()
    placed = placed.groupBy(
        "batch_id", F.when(is_placed, "region").otherwise("order").alias("part"),
        F.when(is_placed, F.col("region_id").cast("string")).otherwise(F.col("order_id").cast("string")).alias("key"),
    ).agg(F.sum("ids").alias("ids"))
    return sums.unionByName(placed, allowMissingColumns=True)


@dataclass(frozen=True)
class Rollup:
    store: Store

    @property
    def _sums(self) -> FactTable:
        return FactTable(self.store.spark, f"{self.store.root}/kpi_sums")

    @property
    def _seen(self) -> FactTable:
        """The order batches that the last refresh saw."""
        return FactTable(self.store.spark, f"{self.store.root}/kpi_orders")

    def refresh(self) -> list[str]:
        """Sum the batches that are new or changed, in one job; returns their names."""
        tickets, orders = self.store.fact_table("tickets"), self.store.fact_table("orders")
        batches, order_batches = tickets.snapshot(), orders.snapshot()
        done = {r.batch_id: r.version for r in self._sums.snapshot()}
        seen = {r.batch_id: r.version for r in self._seen.snapshot()}
        present = {r.batch_id: r.version for r in order_batches}
        if any(present.get(b) != v for b, v in seen.items()):
            wanted = batches
        else:
            wanted = [r for r in batches if done.get(r.batch_id) != r.version]
            if present != seen:
                wanted += self._waiting(batches, {r.batch_id for r in wanted})
        if wanted:
            names = [r.batch_id for r in wanted]
            rows = tickets.read(wanted)
            # Folders of several batches also hold others than those wanted.
            rows = rows.where(F.col("batch_id").isin(names))
            self._sums.replace_many(partials(rows, orders.read(order_batches)), {r.batch_id: r.version for r in wanted})
        if present != seen:
            marks = self.store.spark.createDataFrame([(b,) for b in sorted(present)], "batch_id string")
            self._seen.replace_many(marks, present)
        return sorted(r.batch_id for r in wanted)

    def _waiting(self, batches: list[Row], without: set[str]) -> list[Row]:
        """Batches that have tickets without a stored order: a list of batch names."""
        kept = self._sums.read()
        if kept is None:
            return []
        found = {r.batch_id for r in kept.where("part = 'order'").select("batch_id").distinct().collect()}
        return [r for r in batches if r.batch_id in found - without]

    def merged(self) -> DataFrame:
        """One row for each part and key: the sums of all batches."""
        kept = self._sums.read()
        if kept is None:
            raise ValueError("no tickets are summed yet: call refresh() after a load")
        return kept.groupBy("part", "key").agg(*[F.sum(name).alias(name) for name in _SUMS])

    def reports(self, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The ten KPI reports, named and shaped like the functions in ``kpi``.

        ``dims`` are regions with their city names, restaurants, drivers, and reasons with
        their category names.
        """
        sums = self.merged()
        # Without any ticket the counts are 0 and the rates NULL.
        one = sums.where("part = 'all'").agg(*[F.sum(name).alias(name) for name in _SUMS])
        count = F.coalesce(F.col("tickets"), F.lit(0))

        def percent(name: str) -> Column:
            return F.round(F.col(name).cast("double") * 100.0 / F.col("tickets"), 2)

        def mean(name: str) -> Column:
            return F.round(F.col(f"{name}_total").cast("double") / F.col(f"{name}_known"), 2)

        # Rows of orders were counted as they were written.
        orders = sum(r.rows for r in self.store.fact_table("orders").snapshot())
        rate = F.when(F.lit(orders) > 0, count.cast("double") * 1000.0 / F.lit(orders))
        return {
            "total_tickets": one.select(count.alias("total_tickets")),
            "sla_breach_rate": one.select(
                percent("first_breached").alias("first_response_breach_rate"),
                percent("resolution_breached").alias("resolution_breach_rate"),
            ),
            "average_times": one.select(
                mean("first").alias("avg_first_response_time_min"),
                mean("resolution").alias("avg_resolution_time_min"),
            ),
            "reopen_rate": one.select(percent("reopened").alias("reopen_rate_pct")),
            "refund_and_revenue": one.select(
                F.col("refund").cast("double").alias("total_refund_amount"),
                F.col("loss").cast("double").alias("total_revenue_impact"),
            ),
            "tickets_by_city_region": self._per_region(sums, dims["regions"]),
            "tickets_by_restaurant": _named(sums, "restaurant", dims["restaurants"], "restaurant_name"),
            "tickets_by_driver": _named(sums, "driver", dims["drivers"], "driver_name"),
            "complaint_rate": one.select(rate.alias("complaint_rate_per_1000_orders")),
            "loss_by_reason_category": _lost(sums, dims["reasons"]),
        }

    def _per_region(self, sums: DataFrame, regions: DataFrame) -> DataFrame:
        counts = sums.where("part = 'region'").select("key", "ids")
        waiting = sums.where("part = 'order'").select(F.col("key").alias("order"), "ids")
        orders = self.store.fact("orders")
        if orders is not None:
            places = orders.select(F.col("order_id").cast("string").alias("order"), F.col("region_id").cast("string").alias("key"))
            waiting = waiting.join(places, "order", "left").select("key", "ids")
        else:
            waiting = waiting.select(F.lit(None).cast("string").alias("key"), "ids")
        return _grouped(counts.unionAll(waiting), regions, "region_id", ["city_name", "region_name"])


def _grouped(counts: DataFrame, dim: DataFrame, key: str, names: list[str]) -> DataFrame:
    counts = counts.groupBy("key").agg(F.sum("ids").alias("ids"))
    named = unique_rows(dim.select(F.col(key).cast("string").alias("key"), *names), ["key"])
    found = counts.join(named, "key", "left").groupBy(*names).agg(F.sum("ids").alias("ticket_count"))
    return found.orderBy(F.desc("ticket_count"), *names)


def _named(sums: DataFrame, part: str, dim: DataFrame, name: str) -> DataFrame:
    return _grouped(sums.where(F.col("part") == part).select("key", "ids"), dim, _KEYS[part], [name])


def _lost(sums: DataFrame, reasons: DataFrame) -> DataFrame:
    name = "reason_category_name"
    named = unique_rows(reasons.select(F.col("reason_id").cast("string").alias("key"), name), ["key"])
    found = sums.where("part = 'reason'").select("key", "loss").join(named, "key", "left")
    found = found.groupBy(name).agg(F.sum("loss").cast("double").alias("total_loss"))
    return found.orderBy(F.desc("total_loss"), name)
