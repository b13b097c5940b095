"""Duplicate checks of facts: within the batch and against stored rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.operators.lookup import LIMITS, Limits, fits_broadcast, lookup_join, unique_rows


@dataclass(frozen=True)
class DuplicateSplit:
    new: DataFrame
    duplicates: DataFrame


def first_per_key(
    df: DataFrame, keys: list[str], copies: str | None = None, deal: bool = True
) -> DataFrame:
    """One row per key: the smallest by its columns from left to right, NULLs first.

    With ``copies`` a column of that name says how many rows the key had; for ``deal``
    see ``unique_rows``.
    """
    return unique_rows(df, keys, copies, deal)


def split_stored(
    df: DataFrame, stored: DataFrame, keys: list[str], limits: Limits = LIMITS
) -> DuplicateSplit:
    """Rows whose key is not stored yet, and rows whose key is.

    When the incoming keys are few they are broadcast to the scan of the stored
    keys, so the history is read in one column and never shuffled.  A batch too
    large for that meets the history in a shuffle on the key.
    """
    incoming = df.select(*keys).dropna("any").distinct()
    known = stored.select(*keys)
    few = bool(fits_broadcast({"incoming": incoming}, limits))
    if few:
        known = known.join(F.broadcast(incoming), keys, "left_semi")
    known = known.distinct().withColumn("__stored", F.lit(True))
    flagged = lookup_join(df, known, keys, "left", limits, True if few else None)
    hit = F.col("__stored").isNotNull()
    return DuplicateSplit(
        flagged.filter(~hit).select(*df.columns), flagged.filter(hit).select(*df.columns)
    )
