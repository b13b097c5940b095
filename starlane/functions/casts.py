"""Casts from text to contract types that yield NULL instead of failing.

Plain casts differ between engines at the edges, so each type first requires a
shape.  All of it is built-in expressions and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.contracts import spark_type

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
_BOOLEAN = r"(?i)^(true|false|t|f|yes|no|y|n|1|0)$"
_NOT_A_NUMBER = r'(?i)^\s*"?nan"?\s*$'


def to_int(text: Column) -> Column:
    """Whole number; ``'5.0'`` is 5 and fractions round half away from zero.

    Going through a decimal keeps all digits of a 64-bit key, which a double
    would not.
    """
    exact = F.round(text.try_cast("decimal(38,10)")).try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(_NUMBER), exact))


def to_float(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER) | text.rlike(_INFINITE), text.try_cast("double"))


def to_date(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(
        trimmed.rlike(_DATE), F.regexp_extract(trimmed, r"^[0-9-]+", 0).try_cast("date")
    )


def to_timestamp(text: Column) -> Column:
    """Zoneless timestamp; a zone offset in the text is ignored, not applied."""
    trimmed = F.trim(text)
    return F.when(
        trimmed.rlike(_TIMESTAMP),
        F.regexp_replace(trimmed, r"(Z|(?<=:\d{2})[+-]\d{2}(:?\d{2})?)$", "").try_cast(
            "timestamp_ntz"
        ),
    )


def to_boolean(text: Column) -> Column:
    return F.when(text.rlike(_BOOLEAN), text.try_cast("boolean"))


_CASTS = {
    "int": to_int,
    "float": to_float,
    "date": to_date,
    "timestamp": to_timestamp,
    "boolean": to_boolean,
}


def from_text(text: Column, type_name: str) -> Column:
    """Contract-typed value of a text column, NULL where it does not convert."""
    spark_type(type_name)
    cast = _CASTS.get(type_name.lower())
    return cast(text) if cast else text


def known(text: Column, type_name: str) -> Column:
    """Text value with the missing-value literal ``NaN`` turned into NULL.

    Text columns keep it: there ``NaN`` may be somebody's name.
    """
    if type_name.lower() == "string":
        return text
    return F.when(~text.rlike(_NOT_A_NUMBER), text)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with NaN as NULL in its fractional columns, as tables keep it."""
    fractional = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in fractional})
