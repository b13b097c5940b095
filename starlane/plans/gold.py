"""Audit, enrich, compute: the way from clean rows to gold rows.

Extra stages are plain functions ``DataFrame -> DataFrame`` registered per
table; they run last, in the order of registration.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from starlane.operators.derive import audit, metrics
from starlane.operators.enrich import enrich
from starlane.operators.lookup import LIMITS, Limits

Stage = Callable[[DataFrame], DataFrame]


class Stages:
    """User stages by table."""

    def __init__(self) -> None:
        self._by_table: dict[str, list[Stage]] = {}

    def add(self, table: str, stage: Stage) -> Stages:
        self._by_table.setdefault(table, []).append(stage)
        return self

    def run(self, df: DataFrame, table: str) -> DataFrame:
        for stage in self._by_table.get(table, []):
            df = df.transform(stage)
        return df


def to_gold(
    df: DataFrame,
    table: str,
    dims: dict[str, DataFrame],
    batch_id: str,
    stages: Stages | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    gold = (
        df.transform(audit, batch_id)
        .transform(enrich, table, dims, limits)
        .transform(metrics, table)
    )
    return stages.run(gold, table) if stages else gold
