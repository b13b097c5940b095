"""The skew-safe derivations agree with the plain ones and with brute force."""

from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from starlane.fixtures import Fixtures, timeline
from starlane.queries import _customers
from starlane.operators.lookup import Limits
from tests.conftest import rows_of

COLUMNS = ["event_id", "next_ts", "next_type", "prev_type", "next_purchase", "last_error"]
TIGHT = Limits(broadcast_rows=2, heavy_rows=5)


def _brute_force(events):
    out = []
    for user in {e[2] for e in events}:
        own = (e for e in events if e[2] == user)
        line = sorted(own, key=lambda e: (e[1] is not None, e[1] or dt.datetime.min, e[0]))
        for i, event in enumerate(line):
            after, upto = line[i + 1 :], line[: i + 1]
            purchases = [e[1] for e in after if e[3] == "purchase" and e[1] is not None]
            errors = [e[0] for e in upto if e[3] == "error"]
            out.append(
                (
                    event[0],
                    after[0][1] if after else None,
                    after[0][3] if after else None,
                    line[i - 1][3] if i else None,
                    min(purchases) if purchases else None,
                    max(errors) if errors else None,
                )
            )
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", ["1", "7", "40"])
def test_time_line_against_brute_force(spark, ranges):
    rng = random.Random(7)
    start = dt.datetime(1969, 12, 31, 23, 50)
    events = [
        (
            i,
            None if rng.random() < 0.1 else start + dt.timedelta(seconds=rng.randint(0, 1500)),
            rng.choice([1, 1, 1, 1, 2, None]),
            rng.choice(["purchase", "error", "view", "click"]),
        )
        for i in rng.sample(range(1000), 300)
    ]
    df = spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string"
    )
    usual = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert rows_of(timeline(df), *COLUMNS) == _brute_force(events)
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)


def test_time_line_of_one_heavy_user_is_linear(spark):
    def seconds(count):
        kinds = F.element_at(F.array(*map(F.lit, ("purchase", "error", "view"))), (F.col("id") % 3 + 1).cast("int"))
        stamp = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
        df = spark.range(count).select(F.col("id").alias("event_id"), stamp.alias("ts"), F.lit(1).alias("user_id"), kinds.alias("event_type"))
        begun = time.time()
        timeline(df).write.format("noop").mode("overwrite").save()
        return time.time() - begun

    seconds(1000)
    assert seconds(160_000) < 4 * seconds(40_000) + 8


@pytest.mark.parametrize("name", ["tickets", "ticket_events", "orders_base", "customers_raw"])
def test_tight_bounds_change_nothing(spark, folder, name):
    usual = getattr(Fixtures(spark, folder), name)
    tight = getattr(Fixtures(spark, folder, TIGHT), name)
    assert rows_of(tight, *usual.columns) == rows_of(usual)


def test_customers_are_checked_once_and_by_many_tasks(spark, folder):
    fx = Fixtures(spark, folder)
    usual = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert fx.table("customer").rdd.getNumPartitions() < fx.customers_raw.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", usual)
    assert _customers(fx) is _customers(fx)
    assert "flag" not in _customers(fx)._jdf.queryExecution().optimizedPlan().toString().lower()
