"""Left joins that add descriptive columns from dimensions.

A missing dimension yields typed NULL columns, so the gold schema stays the
same whether or not it has arrived; a real error is raised.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.contracts import CONTRACTS, spark_type
from starlane.operators.lookup import LIMITS, Limits, fits_broadcast, lookup_join, unique_rows


@dataclass(frozen=True)
class Enrichment:
    """Columns that one dimension adds: gold name -> column of the dimension."""

    dim: str
    key: str
    adds: dict[str, str]


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


ENRICHMENTS: dict[str, list[Enrichment]] = {
    "customers": [
        Enrichment("segments", "segment_id", _same("segment_name", "discount_pct"))
    ],
    "regions": [
        Enrichment("cities", "city_id", _same("city_name", "country", "timezone"))
    ],
    "agents": [Enrichment("teams", "team_id", _same("team_name"))],
    "reasons": [
        Enrichment(
            "reason_categories",
            "reason_category_id",
            {"reason_category_name": "category_name"},
        )
    ],
    "tickets": [
        Enrichment(
            "priorities",
            "priority_id",
            _same("sla_first_response_min", "sla_resolution_min"),
        ),
        Enrichment("channels", "channel_id", _same("channel_name")),
    ],
}


def _lookup_side(dim: DataFrame, e: Enrichment) -> DataFrame:
    wanted = dim.select(
        e.key, *[F.col(source).alias(name) for name, source in e.adds.items()]
    )
    return unique_rows(wanted.filter(F.col(e.key).isNotNull()), [e.key])


def enrich(
    df: DataFrame,
    table: str,
    dims: dict[str, DataFrame],
    limits: Limits = LIMITS,
) -> DataFrame:
    """Add the columns declared for ``table``; other tables pass through."""
    steps = ENRICHMENTS.get(table, [])
    sides = {e.dim: _lookup_side(dims[e.dim], e) for e in steps if e.dim in dims}
    small = fits_broadcast(sides, limits)
    for e in steps:
        if e.dim in sides:
            df = lookup_join(df, sides[e.dim], [e.key], "left", limits, e.dim in small)
        else:
            types = CONTRACTS[e.dim].types
            df = df.withColumns(
                {
                    name: F.lit(None).cast(spark_type(types[source]))
                    for name, source in e.adds.items()
                }
            )
    return df
