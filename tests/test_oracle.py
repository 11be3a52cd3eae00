"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_compare import compare, duck
from unilake.plans.queries import QUERIES as LIBRARY

QUERIES = {k: v for k, v in entry_mod.queries().items() if k in LIBRARY}
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in LIBRARY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_ORACLE)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_sk"


def test_entry_schema_stable(spark):
    a = entry_mod.entry(spark).schema
    b = QUERIES["unified_customers"](spark, SF_SMALL).schema
    assert a == b
