"""The quality gate: file name, columns, types, formats, required values.

Row checks are column expressions over the raw text.  ``flag_rows`` puts the
verdict of all three checks on each row in one pass; the clean and the bad side
are then two complementary filters on that verdict, so no row is lost or
counted twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.contracts import (
    CONTRACTS,
    FORMAT_PATTERNS,
    RETRYABLE,
    TableContract,
    contract_type,
)
from starlane.functions.casts import from_text, known
from starlane.sources.files import table_name

ERROR_TYPE = "__error_type"
FAILED = "__failed"


@dataclass(frozen=True)
class Split:
    """The two sides of a check; ``bad`` carries the failing columns per row."""

    clean: DataFrame
    bad: DataFrame


@dataclass(frozen=True)
class SchemaVerdict:
    """Outcome of the file-level checks; ``reason`` is empty when it passed."""

    table: str
    reason: str = ""

    @property
    def passed(self) -> bool:
        return not self.reason


def check_file_name(path: str) -> SchemaVerdict:
    table = table_name(path)
    return SchemaVerdict(table, "" if table in CONTRACTS else "unknown table")


def check_columns(columns: list[str], contract: TableContract) -> SchemaVerdict:
    """Same names in any order and letter case, nothing missing, nothing extra."""
    expected = [c.lower() for c in contract.columns]
    actual = [c.lower() for c in columns]
    missing = sorted(set(expected) - set(actual))
    extra = sorted(set(actual) - set(expected))
    reason = ""
    if len(actual) != len(expected):
        reason = f"column count {len(actual)}, expected {len(expected)}"
    elif missing:
        reason = f"missing {', '.join(missing)}"
    elif extra:
        reason = f"extra {', '.join(extra)}"
    return SchemaVerdict(contract.name, reason)


def _text(df: DataFrame, contract: TableContract, column: str) -> Column:
    return known(F.col(column).cast("string"), contract.types[column])


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def _needs_cast(df: DataFrame, contract: TableContract) -> list[str]:
    """Columns whose type differs from the contract's."""
    return [
        c
        for c in _present(df, contract.columns)
        if contract_type(df.schema[c].dataType) != contract.types[c].lower()
    ]


def _failing(conditions: dict[str, Column]) -> Column:
    """Names of the columns whose condition holds, as an array."""
    if not conditions:
        return F.array().cast("array<string>")
    return F.array_compact(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in conditions.items()])
    )


def type_failures(df: DataFrame, contract: TableContract) -> Column:
    """Columns that hold a value which does not convert to the contract type."""
    conditions = {}
    for c in _needs_cast(df, contract):
        text = _text(df, contract, c)
        conditions[c] = text.isNotNull() & from_text(text, contract.types[c]).isNull()
    return _failing(conditions)


def format_failures(df: DataFrame, contract: TableContract) -> Column:
    """Columns that hold a value which does not look as declared; NULL passes."""
    return _failing(
        {
            c: F.col(c).isNotNull() & ~F.col(c).rlike(FORMAT_PATTERNS[contract.formats[c]])
            for c in _present(df, contract.formats)
        }
    )


def null_failures(df: DataFrame, contract: TableContract) -> Column:
    """Required columns without a value."""
    return _failing(
        {c: _text(df, contract, c).isNull() for c in _present(df, contract.required)}
    )


def cast_to_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    to_cast = set(_needs_cast(df, contract))
    return df.select(
        [
            from_text(_text(df, contract, c), contract.types[c]).alias(c)
            if c in to_cast
            else F.col(c)
            for c in df.columns
        ]
    )


def _split(df: DataFrame, failed: Column) -> Split:
    flagged = df.withColumn(FAILED, failed)
    ok = F.size(FAILED) == 0
    return Split(flagged.filter(ok).drop(FAILED), flagged.filter(~ok))


def split_types(df: DataFrame, contract: TableContract) -> Split:
    sides = _split(df, type_failures(df, contract))
    return Split(cast_to_contract(sides.clean, contract), sides.bad)


def split_formats(df: DataFrame, contract: TableContract) -> Split:
    return _split(df, format_failures(df, contract))


def split_nulls(df: DataFrame, contract: TableContract) -> Split:
    return _split(df, null_failures(df, contract))


def flag_rows(raw: DataFrame, contract: TableContract) -> DataFrame:
    """``raw`` with the first failing check of each row and its columns.

    Adds ``__error_type`` (NULL for good rows) and ``__failed``.
    """
    checks = {
        "TYPE_MISMATCH": type_failures(raw, contract),
        "FORMAT_ERROR": format_failures(raw, contract),
        "NULL_REQUIRED_COLUMN": null_failures(raw, contract),
    }
    flagged = raw.withColumns({f"__{name}": failed for name, failed in checks.items()})
    names = list(checks)
    verdict = F.coalesce(
        *[F.when(F.size(f"__{name}") > 0, F.lit(name)) for name in names]
    )
    failed = F.coalesce(
        *[F.when(F.size(f"__{name}") > 0, F.col(f"__{name}")) for name in names]
    )
    return flagged.withColumns({ERROR_TYPE: verdict, FAILED: failed}).drop(
        *[f"__{name}" for name in names]
    )


def clean_rows(flagged: DataFrame, contract: TableContract) -> DataFrame:
    good = flagged.filter(F.col(ERROR_TYPE).isNull()).drop(ERROR_TYPE, FAILED)
    return cast_to_contract(good, contract)


def bad_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(ERROR_TYPE).isNotNull())


def _as_payload_text(df: DataFrame, column: str) -> Column:
    text = F.col(column).cast("string")
    if contract_type(df.schema[column].dataType) == "timestamp":
        return F.replace(text, F.lit(" "), F.lit("T"))
    return text


def payload(
    df: DataFrame,
    columns: list[str],
    table: str,
    error_type: Column,
    error_column: Column,
    fk_table: Column,
) -> Column:
    """The rejected row and why, as JSON; NULLs are kept, times are ISO text."""
    row = F.struct([_as_payload_text(df, c).alias(c) for c in columns])
    return F.to_json(
        F.struct(
            row.alias("row"),
            error_type.alias("error_type"),
            error_column.alias("error_column"),
            fk_table.alias("fk_table"),
            F.lit(table).alias("table_name"),
        ),
        {"ignoreNullFields": "false"},
    )


def _key_text(contract: TableContract) -> Column:
    """The key as text, parts joined by ``_``; NULL if any part is."""
    parts = [F.col(c).cast("string") for c in contract.primary_key]
    whole = parts[0]
    for part in parts[1:]:
        whole = F.concat(whole, F.lit("_"), part)
    return whole


def error_rows(
    bad: DataFrame,
    contract: TableContract,
    batch_id: str,
    error_type: Column | None = None,
    error_column: Column | None = None,
    fk_table: Column | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Quarantine rows without the clock and the random id.

    Row identity depends on the check: type and null failures use the key, or a
    digest of the row where the key is missing; format failures are prefixed by
    the table.
    """
    kind = F.col(ERROR_TYPE) if error_type is None else error_type
    if error_column is None:
        error_column = F.when(kind == "TYPE_MISMATCH", "multiple").otherwise(
            F.array_join(FAILED, ", ")
        )
    fk_table = F.lit(None).cast("string") if fk_table is None else fk_table
    columns = columns or [c for c in bad.columns if c in contract.types]
    body = payload(bad, columns, contract.name, kind, error_column, fk_table)
    key = _key_text(contract)
    event_id = (
        F.when(kind == "FORMAT_ERROR", F.concat(F.lit(f"{contract.name}:"), key))
        .when(
            kind == "TYPE_MISMATCH", F.coalesce(key, F.concat(F.lit("type_"), F.md5(body)))
        )
        .when(
            kind == "NULL_REQUIRED_COLUMN",
            F.coalesce(key, F.concat(F.lit("null_row_"), F.md5(body))),
        )
        .otherwise(key)
    )
    retryable = F.coalesce(
        *[F.when(kind == name, F.lit(flag)) for name, flag in RETRYABLE.items()]
    )
    return bad.select(
        event_id.alias("event_id"),
        F.lit(contract.name).alias("table_name"),
        F.lit(batch_id).alias("batch_id"),
        body.alias("raw_payload"),
        kind.alias("error_type"),
        error_column.alias("error_column"),
        fk_table.alias("fk_table"),
        retryable.alias("retryable"),
    )
