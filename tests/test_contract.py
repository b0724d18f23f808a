"""Registered queries against their SQL, over whole tables."""

from __future__ import annotations

import oracle_compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from retalake.plans.oracle import ORACLES
from retalake.plans.queries import all_queries


@pytest.fixture(scope="module")
def base():
    return oracle_compare.duck(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(ORACLES)
    assert set(all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["ano", "turno_compra", "vendas", "valor_liquido"]
    assert df.count() == 28


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_its_sql(spark, base, name):
    rows, problem = oracle_compare.compare(spark, base, SF_DIR, name)
    assert not problem
    assert rows > 0
