"""Joins against a side with unique keys, safe for any size and any skew.

Three ways, all with the same result:

* the lookup side is measured and small: broadcast, the fact is not shuffled;
* it is too large, and no fact key is heavy: a plain join, Catalyst and AQE
  pick the algorithm;
* it is too large and some fact keys are heavy: rows of the heavy keys, and rows
  without a key, take a broadcast of just those keys' lookup rows, all others
  the plain join.  Rows
  are told apart by value, never by a random salt, so a re-run task after a
  lost executor sends every row the same way, and even identical copies of one
  row spread over all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.session import materialize


@dataclass(frozen=True)
class Limits:
    """Bounds behind each broadcast, and from how many rows on a key is heavy."""

    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 << 20
    heavy_rows: int = 1_000_000


LIMITS = Limits()


def _row_bytes(schema: T.StructType):
    """Upper estimate of one row's bytes: measured text, 16 for the rest."""
    parts = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16
        if isinstance(f.dataType, T.StringType)
        else F.lit(16)
        for f in schema.fields
    ]
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def fits_broadcast(sides: dict[str, DataFrame], limits: Limits = LIMITS) -> set[str]:
    """Names of the frames within the broadcast bounds, measured in one job.

    Rows and bytes are summed where they lie; one row of sums moves per task.
    """
    if not sides:
        return set()
    measured = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("size"))
        .select(F.lit(name).alias("name"), "n", "size")
        for name, df in sides.items()
    ]
    rows = reduce(DataFrame.unionAll, measured).collect()
    return {
        r["name"]
        for r in rows
        if r["n"] <= limits.broadcast_rows and (r["size"] or 0) <= limits.broadcast_bytes
    }


def heavy_keys(df: DataFrame, keys: list[str], limits: Limits = LIMITS) -> DataFrame | None:
    """The keys holding so many rows that one task should not get them all.

    Counting combines before the shuffle, and every key past the bound is among
    them.  NULL counts as a key: a shuffle sends all NULLs to one task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    found = materialize(counts.filter(F.col("rows") >= limits.heavy_rows).select(*keys), "heavy")
    return None if found.isEmpty() else found


def large_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Join where the lookup side may be any size.

    Should the heavy keys' lookup rows be too many to broadcast, the join is the
    plain one, whose skewed partitions adaptive execution splits.
    """
    hot = heavy_keys(left, keys, limits)
    if hot is None or not fits_broadcast({"hot": hot}, limits):
        return left.join(right, keys, how)
    few = materialize(right.join(F.broadcast(hot), keys, "left_semi"), "heavy-lookup")
    if not fits_broadcast({"few": few}, limits):
        return left.join(right, keys, how)
    tagged = left.join(F.broadcast(hot.withColumn("__heavy", F.lit(True))), keys, "left")
    without_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = F.col("__heavy").isNotNull() | without_key
    plain = tagged.filter(~apart).drop("__heavy")
    heavy = tagged.filter(apart).drop("__heavy")
    return plain.join(right, keys, how).unionByName(heavy.join(F.broadcast(few), keys, how))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    limits: Limits = LIMITS,
    small: bool | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, whose ``keys`` are unique.

    ``small`` passes on an earlier measurement of ``right``.
    """
    if small is None:
        small = bool(fits_broadcast({"right": right}, limits))
    if small:
        return left.join(F.broadcast(right), keys, how)
    return large_join(left, right, keys, how, limits)


def unique_rows(
    dim: DataFrame, keys: list[str], copies: str | None = None, deal: bool = True
) -> DataFrame:
    """One row per key, the smallest by all other columns; ``copies`` names a count of its rows.

    Aggregation instead of a window: copies of one key combine before the
    shuffle, so no task holds a whole group.  The smallest row is found by
    sorting, so rows are dealt by a hash of the key first, or the few tasks that
    read a file of few row groups would sort it all; adaptive execution cuts
    what a heavy key makes too large, and the parts' rows meet by key.  Without
    ``deal`` they are sorted where they lie, for rows that many tasks have written.
    """
    rest = [c for c in dim.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not rest and not counted:
        return dim.distinct()
    row = [F.min(F.struct(*rest)).alias("__row")] if rest else []
    return (
        (dim.withColumn("__deal", F.xxhash64(*keys)).hint("rebalance", "__deal") if rest and deal else dim)
        .groupBy(*keys)
        .agg(*row, *counted)
        .select(*keys, *(["__row.*"] if rest else []), *([copies] if copies else []))
        .select(*dim.columns, *([copies] if copies else []))
    )
