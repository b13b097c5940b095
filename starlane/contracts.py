"""Table contracts: columns, types, keys, formats and quality thresholds.

A contract is the only description of a table in the engine.  Readers take
their column list from it, gates take their checks from it, sinks take their
target name and load mode from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Contract type vocabulary and the Spark type each one stands for.
SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


class UnknownContractType(ValueError):
    """A contract names a type outside the six-type vocabulary."""


def spark_type(name: str) -> T.DataType:
    """Spark type for a contract type name, case-insensitive."""
    try:
        return SPARK_TYPES[name.lower()]
    except KeyError:
        raise UnknownContractType(
            f"unknown contract type {name!r}; valid types: {sorted(SPARK_TYPES)}"
        ) from None


def contract_type(dtype: T.DataType) -> str:
    """Contract type name for a Spark type, ``"unknown"`` outside the vocabulary."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    return "unknown"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class TableContract:
    """One table: ordered typed columns, key, required columns, references.

    A ``dim`` is overwritten by each load, a ``fact`` is appended to.
    """

    name: str
    kind: str
    types: dict[str, str]
    primary_key: tuple[str, ...]
    required: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    formats: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def target(self) -> str:
        return f"{self.kind}_{self.name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, spark_type(t)) for c, t in self.types.items()]
        )

    @property
    def text_schema(self) -> T.StructType:
        """Every column as text: what readers use, so nothing is guessed."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.types])

    @property
    def checked_foreign_keys(self) -> tuple[ForeignKey, ...]:
        """References to dimensions, in declared order; fact references are not checked."""
        return tuple(
            fk for fk in self.foreign_keys if CONTRACTS[fk.table].kind == "dim"
        )


# The sixteen table contracts.
CONTRACTS: dict[str, TableContract] = {
    "customers": TableContract(
        name="customers",
        kind="dim",
        types={
            "customer_id": "int",
            "full_name": "string",
            "email": "string",
            "phone": "string",
            "region_id": "int",
            "segment_id": "int",
            "signup_date": "date",
            "gender": "string",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        primary_key=("customer_id",),
        required=("customer_id", "region_id", "segment_id"),
        foreign_keys=(
            ForeignKey("region_id", "regions", "region_id"),
            ForeignKey("segment_id", "segments", "segment_id"),
        ),
        formats={"email": "email", "phone": "phone"},
    ),
    "drivers": TableContract(
        name="drivers",
        kind="dim",
        types={
            "driver_id": "int",
            "driver_name": "string",
            "driver_phone": "string",
            "national_id": "string",
            "region_id": "int",
            "shift": "string",
            "vehicle_type": "string",
            "hire_date": "date",
            "rating_avg": "float",
            "on_time_rate": "float",
            "cancel_rate": "float",
            "completed_deliveries": "int",
            "is_active": "boolean",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        primary_key=("driver_id",),
        required=("driver_id", "driver_name", "national_id", "region_id"),
        foreign_keys=(
            ForeignKey("region_id", "regions", "region_id"),
        ),
        formats={"driver_phone": "phone"},
    ),
    "restaurants": TableContract(
        name="restaurants",
        kind="dim",
        types={
            "restaurant_id": "int",
            "restaurant_name": "string",
            "region_id": "int",
            "category_id": "int",
            "price_tier": "string",
            "rating_avg": "float",
            "prep_time_avg_min": "int",
            "is_active": "boolean",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        primary_key=("restaurant_id",),
        required=("restaurant_id", "region_id", "category_id"),
        foreign_keys=(
            ForeignKey("region_id", "regions", "region_id"),
            ForeignKey("category_id", "categories", "category_id"),
        ),
    ),
    "agents": TableContract(
        name="agents",
        kind="dim",
        types={
            "agent_id": "int",
            "agent_name": "string",
            "agent_email": "string",
            "agent_phone": "string",
            "team_id": "int",
            "skill_level": "string",
            "hire_date": "date",
            "avg_handle_time_min": "float",
            "resolution_rate": "float",
            "csat_score": "float",
            "is_active": "boolean",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        primary_key=("agent_id",),
        required=("agent_id", "agent_name", "team_id"),
        foreign_keys=(
            ForeignKey("team_id", "teams", "team_id"),
        ),
        formats={"agent_email": "email", "agent_phone": "phone"},
    ),
    "teams": TableContract(
        name="teams",
        kind="dim",
        types={
            "team_id": "int",
            "team_name": "string",
        },
        primary_key=("team_id",),
        required=("team_id", "team_name"),
    ),
    "channels": TableContract(
        name="channels",
        kind="dim",
        types={
            "channel_id": "int",
            "channel_name": "string",
        },
        primary_key=("channel_id",),
        required=("channel_id", "channel_name"),
    ),
    "priorities": TableContract(
        name="priorities",
        kind="dim",
        types={
            "priority_id": "int",
            "priority_code": "string",
            "priority_name": "string",
            "sla_first_response_min": "int",
            "sla_resolution_min": "int",
        },
        primary_key=("priority_id",),
        required=("priority_id", "priority_code"),
    ),
    "reason_categories": TableContract(
        name="reason_categories",
        kind="dim",
        types={
            "reason_category_id": "int",
            "category_name": "string",
        },
        primary_key=("reason_category_id",),
        required=("reason_category_id", "category_name"),
    ),
    "cities": TableContract(
        name="cities",
        kind="dim",
        types={
            "city_id": "int",
            "city_name": "string",
            "country": "string",
            "timezone": "string",
        },
        primary_key=("city_id",),
        required=("city_id", "city_name"),
    ),
    "categories": TableContract(
        name="categories",
        kind="dim",
        types={
            "category_id": "int",
            "category_name": "string",
        },
        primary_key=("category_id",),
        required=("category_id", "category_name"),
    ),
    "regions": TableContract(
        name="regions",
        kind="dim",
        types={
            "region_id": "int",
            "region_name": "string",
            "city_id": "int",
            "delivery_base_fee": "float",
        },
        primary_key=("region_id",),
        required=("region_id", "region_name", "city_id"),
        foreign_keys=(
            ForeignKey("city_id", "cities", "city_id"),
        ),
    ),
    "segments": TableContract(
        name="segments",
        kind="dim",
        types={
            "segment_id": "int",
            "segment_name": "string",
            "discount_pct": "float",
            "priority_support": "boolean",
        },
        primary_key=("segment_id",),
        required=("segment_id", "segment_name"),
    ),
    "reasons": TableContract(
        name="reasons",
        kind="dim",
        types={
            "reason_id": "int",
            "reason_name": "string",
            "reason_category_id": "int",
            "severity_level": "string",
            "typical_refund_pct": "float",
        },
        primary_key=("reason_id",),
        required=("reason_id", "reason_name", "reason_category_id"),
        foreign_keys=(
            ForeignKey("reason_category_id", "reason_categories", "reason_category_id"),
        ),
    ),
    "orders": TableContract(
        name="orders",
        kind="fact",
        types={
            "order_id": "string",
            "customer_id": "int",
            "restaurant_id": "int",
            "driver_id": "int",
            "region_id": "int",
            "order_amount": "float",
            "delivery_fee": "float",
            "discount_amount": "float",
            "total_amount": "float",
            "order_status": "string",
            "payment_method": "string",
            "order_created_at": "timestamp",
            "delivered_at": "timestamp",
        },
        primary_key=("order_id",),
        required=("order_id", "customer_id", "restaurant_id", "driver_id", "region_id"),
        foreign_keys=(
            ForeignKey("customer_id", "customers", "customer_id"),
            ForeignKey("restaurant_id", "restaurants", "restaurant_id"),
            ForeignKey("driver_id", "drivers", "driver_id"),
            ForeignKey("region_id", "regions", "region_id"),
        ),
    ),
    "tickets": TableContract(
        name="tickets",
        kind="fact",
        types={
            "ticket_id": "string",
            "order_id": "string",
            "customer_id": "int",
            "driver_id": "int",
            "restaurant_id": "int",
            "agent_id": "int",
            "reason_id": "int",
            "priority_id": "int",
            "channel_id": "int",
            "status": "string",
            "refund_amount": "float",
            "created_at": "timestamp",
            "first_response_at": "timestamp",
            "resolved_at": "timestamp",
            "sla_first_due_at": "timestamp",
            "sla_resolve_due_at": "timestamp",
        },
        primary_key=("ticket_id",),
        required=(
            "ticket_id", "order_id", "agent_id", "customer_id", "driver_id", "restaurant_id",
            "reason_id", "priority_id", "channel_id",
        ),
        foreign_keys=(
            ForeignKey("order_id", "orders", "order_id"),
            ForeignKey("agent_id", "agents", "agent_id"),
            ForeignKey("customer_id", "customers", "customer_id"),
            ForeignKey("restaurant_id", "restaurants", "restaurant_id"),
            ForeignKey("driver_id", "drivers", "driver_id"),
            ForeignKey("reason_id", "reasons", "reason_id"),
            ForeignKey("channel_id", "channels", "channel_id"),
            ForeignKey("priority_id", "priorities", "priority_id"),
        ),
    ),
    "ticket_events": TableContract(
        name="ticket_events",
        kind="fact",
        types={
            "event_id": "string",
            "ticket_id": "string",
            "agent_id": "int",
            "event_ts": "timestamp",
            "old_status": "string",
            "new_status": "string",
            "notes": "string",
        },
        primary_key=("event_id",),
        required=("event_id", "ticket_id", "agent_id", "event_ts"),
        foreign_keys=(
            ForeignKey("ticket_id", "tickets", "ticket_id"),
            ForeignKey("agent_id", "agents", "agent_id"),
        ),
    ),
}

# Accepted text formats.
FORMAT_PATTERNS = {
    "email": r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$",
    "phone": r"^\+?[0-9\s\-\(\)]{7,20}$",
}

# Alert thresholds.  Percentages, but for the duplicate alert,
# which is a fraction of the batch.
THRESHOLDS = {
    "max_null_percentage": 5.0,
    "max_duplicate_percentage": 1.0,
    "max_orphan_percentage": 2.0,
    "max_duplicate_rate": 0.10,
}

# Service-level defaults in minutes, and the retry limit.
DEFAULT_SLA_FIRST_MIN = 1
DEFAULT_SLA_RESOLVE_MIN = 15
MAX_RETRIES = 5

# Quarantine reasons and whether a later retry can cure them.
RETRYABLE = {
    "TYPE_MISMATCH": False,
    "FORMAT_ERROR": True,
    "NULL_REQUIRED_COLUMN": False,
    "FK_MISSING": True,
}


def table_kind(table: str) -> str:
    """``dim`` or ``fact``; a table without a contract is loaded as a dimension."""
    contract = CONTRACTS.get(table)
    return contract.kind if contract else "dim"


def target_name(table: str) -> str:
    return f"{table_kind(table)}_{table}"


def fact_tables() -> list[str]:
    return [name for name, c in CONTRACTS.items() if c.kind == "fact"]
