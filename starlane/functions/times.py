"""Time arithmetic on zoneless timestamps, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from ``start`` to ``end``; NULL if either is NULL."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return seconds.cast("double") / F.lit(60.0)


def date_id(ts: Column) -> Column:
    """Date key as the integer ``yyyymmdd``; NULL stays NULL."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
