"""Writers for CSV and JSON drops, one file per partition, in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exact_text(df: DataFrame) -> list[Column]:
    """Times as their full text, everything else as it is."""
    times = (T.TimestampType, T.TimestampNTZType)
    return [
        F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, times)
        else F.col(f.name)
        for f in df.schema.fields
    ]


def write_csv(df: DataFrame, path: str) -> None:
    df.select(_exact_text(df)).write.option("header", True).option("escape", '"').csv(path)


def _enclose(start: str, end: str):
    """Partition function that makes one JSON value of a partition's lines."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = False
        for batch in batches:
            if batch.empty:
                continue
            text = "," + batch["value"]
            if not opened:
                text.iloc[0] = start + text.iloc[0][1:]
                opened = True
            yield pd.DataFrame({"value": text})
        if opened:
            yield pd.DataFrame({"value": [end]})

    return lines


def _record(df: DataFrame) -> Column:
    return F.to_json(F.struct(_exact_text(df)), {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str) -> None:
    """Files that each hold an array of records."""
    df.select(_record(df).alias("value")).mapInPandas(
        _enclose("[", "]"), "value string"
    ).write.option("compression", "none").format("text").save(path)


def write_keyed_json(df: DataFrame, key: str, path: str) -> None:
    """Files that each hold one object of records by key."""
    name = F.to_json(F.struct(F.col(key).cast("string").alias("k")))
    quoted = F.regexp_extract(name, r'^\{"k":(.*)\}$', 1)
    df.select(F.concat(quoted, F.lit(":"), _record(df)).alias("value")).mapInPandas(
        _enclose("{", "}"), "value string"
    ).write.format("text").save(path)
