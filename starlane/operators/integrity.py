"""Foreign-key checks of facts against dimensions.

A row is charged to its first missing reference, in declared order.  A NULL
reference is missing.  Rows leave by key: every copy of a charged key goes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.contracts import ForeignKey, TableContract
from starlane.operators.lookup import LIMITS, Limits, fits_broadcast, lookup_join
from starlane.session import materialize

# Writes an intermediate table under a label and reads it back.
Stager = Callable[[DataFrame, str], DataFrame]

FK_RANK = "__fk_rank"
KEY_RANK = "__key_rank"


@dataclass(frozen=True)
class OrphanSplit:
    clean: DataFrame
    charged: DataFrame


def checked_references(
    contract: TableContract, dims: dict[str, DataFrame], columns: list[str]
) -> list[ForeignKey]:
    return [
        fk
        for fk in contract.checked_foreign_keys
        if fk.table in dims and fk.column in columns
    ]


def skipped_references(contract: TableContract, dims: dict[str, DataFrame]) -> list[str]:
    """Dimensions that a check needs but that have not been loaded."""
    return [fk.table for fk in contract.checked_foreign_keys if fk.table not in dims]


def rank_references(
    df: DataFrame,
    contract: TableContract,
    dims: dict[str, DataFrame],
    limits: Limits = LIMITS,
    stage: Stager = materialize,
) -> DataFrame:
    """``df`` with the rank of its first missing reference, NULL if none is.

    A small dimension is broadcast.  For a large one only the distinct
    references are shuffled against its keys; the few that miss are written
    out, measured and looked up, so wide fact rows move only if even the
    missing keys are too many.
    """
    references = checked_references(contract, dims, df.columns)
    keys = {
        fk.table: dims[fk.table].select(F.col(fk.key)).dropna() for fk in references
    }
    small = fits_broadcast(keys, limits)
    missing = []
    for rank, fk in enumerate(references, 1):
        mark = f"__mark{rank}"
        known = keys[fk.table].select(F.col(fk.key).alias(fk.column)).distinct()
        if fk.table in small:
            df = lookup_join(
                df, known.withColumn(mark, F.lit(True)), [fk.column], "left", limits, True
            )
            absent = F.col(mark).isNull()
        else:
            absent_keys = stage(
                df.select(fk.column).dropna().distinct().join(known, fk.column, "left_anti"),
                f"missing-{fk.table}",
            )
            df = lookup_join(
                df, absent_keys.withColumn(mark, F.lit(True)), [fk.column], "left", limits
            )
            absent = F.col(mark).isNotNull() | F.col(fk.column).isNull()
        missing.append(F.when(absent, F.lit(rank)))
    rank = F.coalesce(*missing) if missing else F.lit(None).cast("int")
    return df.withColumn(FK_RANK, rank).drop(
        *[f"__mark{i}" for i in range(1, len(references) + 1)]
    )


def charge(
    ranked: DataFrame, contract: TableContract, dims: dict[str, DataFrame], columns: list[str]
) -> DataFrame:
    """Name the missing reference of ranked rows: column, value, dimension."""
    names = list(enumerate(checked_references(contract, dims, columns), 1))
    if not names:
        return ranked.select(
            *columns, *[F.lit(None).cast("string").alias(c) for c in ("fk_column", "fk_value", "dim_name")]
        )

    def pick(value):
        return F.coalesce(*[F.when(F.col(FK_RANK) == i, value(fk)) for i, fk in names])

    return ranked.select(
        *columns,
        pick(lambda fk: F.lit(fk.column)).alias("fk_column"),
        pick(lambda fk: F.col(fk.column).cast("string")).alias("fk_value"),
        pick(lambda fk: F.lit(fk.table)).alias("dim_name"),
    )


def split_orphans(
    df: DataFrame,
    contract: TableContract,
    dims: dict[str, DataFrame],
    limits: Limits = LIMITS,
    staged: bool = False,
    stage: Stager = materialize,
) -> OrphanSplit:
    """Clean rows, and orphan rows with the reference they are charged to.

    Once a reference removed a key, later references no longer see its copies.
    ``staged`` writes the checked rows out first; it pays off where ``df`` is
    costly to compute again for each side.
    """
    columns = df.columns
    pk = list(contract.primary_key)
    ranked = rank_references(df, contract, dims, limits, stage)
    if staged:
        ranked = stage(ranked, f"checked-{contract.name}")
    orphans = ranked.filter(F.col(FK_RANK).isNotNull())
    removed = stage(
        orphans.groupBy(*pk).agg(F.min(FK_RANK).alias(KEY_RANK)), "orphan-keys"
    )
    if removed.isEmpty():
        return OrphanSplit(
            ranked.select(*columns),
            charge(ranked.filter(F.lit(False)), contract, dims, columns),
        )
    joined = lookup_join(ranked, removed, pk, "left", limits)
    charged = joined.filter(F.col(FK_RANK) == F.col(KEY_RANK))
    return OrphanSplit(
        joined.filter(F.col(KEY_RANK).isNull()).select(*columns),
        charge(charged, contract, dims, columns),
    )


def first_missing(
    df: DataFrame,
    contract: TableContract,
    dims: dict[str, DataFrame],
    limits: Limits = LIMITS,
) -> DataFrame:
    """Every row that misses a reference, charged to its own first one."""
    ranked = rank_references(df, contract, dims, limits)
    return charge(ranked.filter(F.col(FK_RANK).isNotNull()), contract, dims, df.columns)
