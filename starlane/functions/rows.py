"""Helpers on whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.contracts import TableContract, spark_type


def conform(df: DataFrame, contract: TableContract, as_text: bool = False) -> DataFrame:
    """All contract columns in order; absent ones as typed NULL."""
    present = set(df.columns)
    return df.select(
        [
            F.col(c) if c in present else F.lit(None).cast("string" if as_text else spark_type(t)).alias(c)
            for c, t in contract.types.items()
        ]
    )
