"""Masked views of the dimensions that hold personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS
from starlane.functions import masks
from starlane.functions.rows import conform

_MASKED_COLUMNS: dict[str, dict[str, tuple[str, str] | None]] = {
    "customers": {
        "full_name": masks.NAME_PAIR,
        "email": masks.EMAIL,
        "phone": masks.PHONE,
    },
    "drivers": {
        "driver_name": masks.NAME_WORD,
        "driver_phone": masks.PHONE,
        "national_id": None,
    },
    "agents": {
        "agent_name": masks.NAME_WORD,
        "agent_email": masks.EMAIL,
        "agent_phone": masks.PHONE,
    },
}

# Names of the masked views.
VIEW_NAMES = {
    "customers": "DimCustomer_analytical",
    "drivers": "DimDriver_analytical",
    "agents": "DimAgent_analytical",
}


def masked_view(dim: DataFrame, table: str, salt: str | None = None) -> DataFrame:
    """The table's own columns, personal ones masked; with a ``salt``, fully hidden.

    Columns that enrichment or a load added are not part of the view; absent
    ones are typed NULL.
    """
    dim = conform(dim, CONTRACTS[table])
    plan = _MASKED_COLUMNS[table]

    def column(name: str) -> Column:
        if name not in plan:
            return F.col(name)
        if salt is not None:
            value = masks.hidden(F.col(name), salt)
        elif plan[name] is None:
            value = masks.digest(F.col(name))
        else:
            value = masks.masked(F.col(name), plan[name])
        return value.alias(name)

    return dim.select([column(c) for c in dim.columns])


def create_views(dims: dict[str, DataFrame], salt: str | None = None) -> list[str]:
    """Register the masked views of the dimensions at hand; returns their names."""
    created = []
    for table, view in VIEW_NAMES.items():
        if table in dims:
            masked_view(dims[table], table, salt).createOrReplaceTempView(view)
            created.append(view)
    return created
