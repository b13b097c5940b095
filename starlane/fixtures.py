"""Delivery tables derived from the given parquet tables, in Spark.

``oracle_sql`` holds the same derivations as SQL text for the other engine.
Here they are written so that one user, order or segment with a third of all
rows does not land in one task: lookups go through measured joins, and the
per-user time line is cut into ranges of user and time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.operators.lookup import LIMITS, Limits, lookup_join
from starlane.session import materialize


def _long(c: str) -> Column:
    return F.col(c).cast("bigint")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _lettered(prefix: str, c: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_text(c), width, "0"))


class Fixtures:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str, limits: Limits = LIMITS):
        self.spark = spark
        self.folder = folder
        self.limits = limits
        self._written: dict[str, DataFrame] = {}

    def written(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, computed at the first use and kept as a table for all later ones."""
        if label not in self._written:
            self._written[label] = materialize(build(), label)
        return self._written[label]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _literal(self, names: str, *rows: str) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")

    @cached_property
    def cities(self) -> DataFrame:
        return self.table("region").select(
            _long("r_regionkey").alias("city_id"),
            F.col("r_name").alias("city_name"),
            F.lit("Testland").alias("country"),
            F.lit("UTC").alias("timezone"),
        )

    @cached_property
    def regions(self) -> DataFrame:
        return self.table("nation").select(
            _long("n_nationkey").alias("region_id"),
            F.col("n_name").alias("region_name"),
            _long("n_regionkey").alias("city_id"),
            (F.lit(10) + F.col("n_nationkey") * F.lit(0.5)).cast("double").alias("delivery_base_fee"),
        )

    @cached_property
    def segments(self) -> DataFrame:
        """Numbered market segments; the distinct segment names are a short list."""
        names = self.table("customer").select("c_mktsegment").distinct()
        return names.select(
            F.row_number().over(Window.orderBy("c_mktsegment")).cast("bigint").alias("segment_id"),
            F.col("c_mktsegment").alias("segment_name"),
            F.length("c_mktsegment").cast("double").alias("discount_pct"),
            (F.col("c_mktsegment") == "BUILDING").alias("priority_support"),
        )

    @cached_property
    def teams(self) -> DataFrame:
        return self.table("region").select(
            _long("r_regionkey").alias("team_id"),
            F.concat(F.lit("Team "), "r_name").alias("team_name"),
        )

    @cached_property
    def agents(self) -> DataFrame:
        key = F.col("n_nationkey")
        level = (
            F.when(key % 3 == 0, "Junior").when(key % 3 == 1, "Mid").otherwise("Senior")
        )
        return self.table("nation").select(
            key.cast("bigint").alias("agent_id"),
            F.concat(F.lit("Agent "), F.regexp_replace("n_name", "_", "-")).alias("agent_name"),
            F.concat(F.lit("agent."), _text("n_nationkey"), F.lit("@desk.example")).alias("agent_email"),
            _lettered("011", "n_nationkey", 8).alias("agent_phone"),
            F.when(key % 12 != 11, _long("n_regionkey")).alias("team_id"),
            level.alias("skill_level"),
        )

    @cached_property
    def channels(self) -> DataFrame:
        return self._literal(
            "channel_id, channel_name",
            "(1L, 'app')",
            "(2L, 'chat')",
            "(3L, 'phone')",
            "(4L, 'email')",
        )

    @cached_property
    def priorities(self) -> DataFrame:
        return self._literal(
            "priority_id, priority_code, priority_name, "
            "sla_first_response_min, sla_resolution_min",
            "(1L, 'P1', 'Critical', 60L, 720L)",
            "(2L, 'P2', 'High', 240L, 1440L)",
            "(3L, 'P3', 'Medium', 480L, 2880L)",
        )

    @cached_property
    def reason_categories(self) -> DataFrame:
        key = _long("r_regionkey") % 3 + 1
        return self.table("region").select(
            key.alias("reason_category_id"),
            F.concat(F.lit("Category "), key.cast("string")).alias("category_name"),
        ).distinct()

    @cached_property
    def reasons(self) -> DataFrame:
        key = _long("r_regionkey")
        return self.table("region").select(
            (key + 1).alias("reason_id"),
            F.col("r_name").alias("reason_name"),
            (key % 3 + 1).alias("reason_category_id"),
            F.length("r_name").cast("string").alias("severity_level"),
            (key.cast("double") * 0.25).alias("typical_refund_pct"),
        )

    @cached_property
    def customers_raw(self) -> DataFrame:
        key = F.col("c_custkey")
        segments = self.segments.select(
            F.col("segment_name").alias("c_mktsegment"), "segment_id"
        )
        letter = F.substring(F.lit("ABCDEFGHIJ"), (key % 10 + 1).cast("int"), F.lit(1))
        # A small file is one split, but its rows' checks are many seconds of work.
        spread = self.table("customer").repartition("c_custkey")
        return lookup_join(
            spread, segments, ["c_mktsegment"], "inner", self.limits
        ).select(
            _text("c_custkey").alias("customer_id"),
            F.concat(F.lit("Cust"), letter, F.lit(" El-"), "c_mktsegment").alias("full_name"),
            F.when(key % 20 == 7, "notanemail")
            .when(key % 20 != 8, F.concat(F.lit("user."), _text("c_custkey"), F.lit("@mail.example")))
            .alias("email"),
            F.when(key % 25 == 3, "N/A").otherwise(_lettered("010", "c_custkey", 8)).alias("phone"),
            F.when(key % 40 == 12, "bad")
            .when(key % 40 != 11, F.concat(_text("c_nationkey"), F.lit(".0")))
            .alias("region_id"),
            _text("segment_id").alias("segment_id"),
            F.when(key % 30 == 5, "invalid").otherwise("2024-01-15").alias("signup_date"),
        )

    @cached_property
    def drivers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("driver_id"),
            F.concat(F.lit("Driver "), _text("s_suppkey")).alias("driver_name"),
            _lettered("012", "s_suppkey", 8).alias("driver_phone"),
            _lettered("2", "s_suppkey", 13).alias("national_id"),
            _long("s_nationkey").alias("region_id"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    @cached_property
    def restaurants(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("restaurant_id"),
            F.concat("p_name", F.lit(" "), "p_brand").alias("restaurant_name"),
            (F.col("p_size") % 25).cast("bigint").alias("region_id"),
            (F.col("p_size") % 10).cast("bigint").alias("category_id"),
            F.col("p_type").alias("price_tier"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        def cents(c: str) -> Column:
            """Exact sum of amounts that all have two decimals."""
            return F.sum(F.rint(F.col(c) * 100).cast("bigint")) / F.lit(100.0)

        return (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_partkey").alias("restaurant_id"),
                F.min("l_suppkey").alias("driver_id"),
                cents("l_extendedprice").alias("order_amount"),
                cents("l_quantity").alias("delivery_fee"),
                F.max("l_shipdate").alias("ship"),
            )
        )

    @cached_property
    def orders_base(self) -> DataFrame:
        nations = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"),
            _long("c_nationkey").alias("region_id"),
        )
        lines = self.lines.withColumnRenamed("l_orderkey", "o_orderkey")
        with_region = lookup_join(
            self.table("orders"), nations, ["o_custkey"], "left", self.limits
        )
        key = F.col("o_orderkey")
        late = F.col("ship") > F.col("o_orderdate")
        return with_region.join(lines, "o_orderkey", "left").select(
            key.cast("string").alias("order_id"),
            F.when(key % 50 == 9, F.col("o_custkey") + 90000000)
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            F.when(key % 70 == 6, F.col("restaurant_id") + 90000000)
            .otherwise(F.col("restaurant_id"))
            .alias("restaurant_id"),
            "driver_id",
            "region_id",
            "order_amount",
            "delivery_fee",
            (key % 5 * 5).cast("double").alias("discount_amount"),
            F.col("o_totalprice").alias("total_amount"),
            F.when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "O", "Cancelled")
            .otherwise("Refunded")
            .alias("order_status"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderdate").alias("order_created_at"),
            F.when(late, F.col("ship")).alias("delivered_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        """The order feed: some orders are sent twice."""
        base = self.orders_base
        times = F.when(F.col("order_id").cast("bigint") % 45 == 4, 2).otherwise(1)
        return base.withColumn("__n", F.explode(F.sequence(F.lit(1), times))).drop("__n")

    @cached_property
    def staged_orders(self) -> DataFrame:
        """The order feed as a written table, for queries that read it many times."""
        return materialize(self.orders, "orders")

    @cached_property
    def ev(self) -> DataFrame:
        """Events with what came before and after in their user's time line."""
        return timeline(self.table("events"))

    @cached_property
    def tickets(self) -> DataFrame:
        events = self.table("events")
        errors = F.col("event_type") == "error"
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
        last_order = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("user_id"))
            .agg(F.max("o_orderkey").alias("l_orderkey"))
            .join(self.lines.select("l_orderkey", "restaurant_id", "driver_id"), "l_orderkey", "left")
        )
        tickets = self.ev.filter(errors).withColumn("k", k)
        joined = tickets.join(last_order, "user_id", "left")
        return joined.select(
            F.concat(F.lit("T"), _text("event_id")).alias("ticket_id"),
            _text("l_orderkey").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            "driver_id",
            "restaurant_id",
            F.when(F.col("k") != 99, F.col("k") % 25).alias("agent_id"),
            (F.col("k") % 5 + 1).alias("reason_id"),
            (F.col("k") % 4 + 1).alias("priority_id"),
            (F.col("k") % 4 + 1).alias("channel_id"),
            F.when(F.col("next_type") == "error", "Reopened")
            .when(F.col("next_purchase").isNull(), "Open")
            .otherwise("Resolved")
            .alias("status"),
            F.when(F.col("k") < 40, F.col("value")).alias("refund_amount"),
            F.col("ts").alias("created_at"),
            F.col("next_ts").alias("first_response_at"),
            F.col("next_purchase").alias("resolved_at"),
        )

    @cached_property
    def ticket_events(self) -> DataFrame:
        return self.ev.select(
            _text("event_id").alias("event_id"),
            F.concat(F.lit("T"), _text("last_error")).alias("ticket_id"),
            (F.col("user_id") % 25).alias("agent_id"),
            F.col("ts").alias("event_ts"),
            F.col("prev_type").alias("old_status"),
            F.col("event_type").alias("new_status"),
            F.col("props").alias("notes"),
        )


def _purchase_ts() -> Column:
    return F.when(F.col("event_type") == "purchase", F.col("ts"))


def _error_id() -> Column:
    return F.when(F.col("event_type") == "error", F.col("event_id"))


def _windowed(events: DataFrame, keys: list[str]) -> DataFrame:
    line = Window.partitionBy(*keys).orderBy("ts", "event_id")
    # What follows is what comes before in reverse order: each row costs the same.
    back = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("event_id"))
    after = back.rowsBetween(Window.unboundedPreceding, -1)
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumns(
        {
            "__after": F.lead(F.struct("ts", "event_type")).over(line),
            "prev_type": F.lag("event_type").over(line),
            "next_purchase": F.min(_purchase_ts()).over(after),
            "last_error": F.max(_error_id()).over(so_far),
        }
    )


def timeline(events: DataFrame) -> DataFrame:
    """``events`` with the next and previous ones of the same user, for users of any size.

    Events are dealt into ranges of user and time, written out, and windows run
    within one range of one user, so no task holds more than its range.  One
    summary row per user and range then carries the neighbours across ranges.  A
    NULL time comes first; a NULL user is a user.
    """
    dealt = events.repartitionByRange("user_id", "ts", "event_id")
    parts = materialize(dealt.withColumn("__part", F.spark_partition_id()), "timeline")
    within = _windowed(parts, ["user_id", "__part"])
    position = F.struct("ts", "event_id", "event_type")
    summary = parts.groupBy("user_id", "__part").agg(
        F.min(position).alias("first"),
        F.max(position).alias("last"),
        F.min(_purchase_ts()).alias("purchase"),
        F.max(_error_id()).alias("error"),
    )
    line = Window.partitionBy("user_id").orderBy("__part")
    back = Window.partitionBy("user_id").orderBy(F.desc("__part"))
    around = summary.select(
        F.col("user_id").alias("__user"),
        F.col("__part").alias("__range"),
        F.lead("first").over(line).alias("__next"),
        F.lag("last").over(line).alias("__prev"),
        F.min("purchase").over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("__purchase"),
        F.max("error").over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("__error"),
    )
    same = F.col("user_id").eqNullSafe(F.col("__user")) & (F.col("__part") == F.col("__range"))
    here = F.col("__after").isNotNull()
    return (
        within.join(around, same, "left")
        .withColumns(
            {
                "next_ts": F.when(here, F.col("__after.ts")).otherwise(F.col("__next.ts")),
                "next_type": F.when(here, F.col("__after.event_type")).otherwise(
                    F.col("__next.event_type")
                ),
                "prev_type": F.coalesce("prev_type", "__prev.event_type"),
                "next_purchase": F.coalesce("next_purchase", "__purchase"),
                "last_error": F.greatest("last_error", "__error"),
            }
        )
        .select(*events.columns, "next_ts", "next_type", "prev_type", "next_purchase", "last_error")
    )
