from __future__ import annotations

import pytest
from pyspark.sql import types as T

from starlane import contracts
from starlane.contracts import CONTRACTS


def test_sixteen_tables_three_facts():
    assert len(CONTRACTS) == 16
    assert contracts.fact_tables() == ["orders", "tickets", "ticket_events"]


def test_targets():
    assert contracts.target_name("orders") == "fact_orders"
    assert contracts.target_name("customers") == "dim_customers"
    assert contracts.target_name("never_heard_of") == "dim_never_heard_of"


def test_fact_references_are_not_checked():
    checked = [fk.column for fk in CONTRACTS["tickets"].checked_foreign_keys]
    assert "order_id" not in checked
    assert checked[0] == "agent_id"


def test_required_columns_and_keys_exist():
    for contract in CONTRACTS.values():
        named = {*contract.primary_key, *contract.required, *contract.formats}
        named |= {fk.column for fk in contract.foreign_keys}
        assert named <= set(contract.types)


def test_types_both_ways():
    for name in contracts.SPARK_TYPES:
        assert contracts.contract_type(contracts.spark_type(name.upper())) == name
    assert contracts.contract_type(T.DecimalType(18, 3)) == "float"
    assert contracts.contract_type(T.ByteType()) == "int"
    assert contracts.contract_type(T.MapType(T.StringType(), T.StringType())) == "unknown"
    with pytest.raises(contracts.UnknownContractType):
        contracts.spark_type("interval")
