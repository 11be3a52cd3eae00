"""Staging mappings and unification (P1-P8, U1, M1-M4, M7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests import fixtures
from unilake.operators.mapping import stage
from unilake.operators.unify import unify
from unilake.plans import build
from unilake.plans.models import (INT_UNIFIED_CUSTOMERS, INT_UNIFIED_PRODUCTS, STAGING,
                                  STG_A_CONTACTS, STG_B_PRODUCTS)


def _staged(spark):
    return build.staged_frames(fixtures.raw_tables(spark))


def test_stage_contacts_renames_and_casts(spark):
    df = stage(fixtures.contacts(spark), STG_A_CONTACTS)
    assert df.columns == ["contact_id", "first_name", "last_name", "email", "phone_number",
                          "organization", "created_at"]
    assert dict(df.dtypes)["contact_id"] == "string"
    assert dict(df.dtypes)["created_at"] == "date"
    r = df.where("contact_id = '4'").first()
    assert r["phone_number"] is None and r["created_at"] == dt.date(2024, 1, 4)
    # column comments travel as metadata (shown by DESCRIBE)
    assert df.schema["email"].metadata["comment"] == "Mail address on file, if any"


def test_stage_products_flag_and_datetime(spark):
    df = stage(fixtures.products(spark), STG_B_PRODUCTS)
    got = {r["product_id"]: (r["is_available"], r["created_at"]) for r in df.collect()}
    assert got["7"][0] is False and got["1"][0] is True
    assert got["1"][1] == dt.date(2024, 3, 1)


def test_unified_counts_follow_union_all(spark):
    st = _staged(spark)
    cust = unify(INT_UNIFIED_CUSTOMERS, st)
    prod = unify(INT_UNIFIED_PRODUCTS, st)
    assert cust.count() == 22 and prod.count() == 21          # no dedup across sources
    # the same person in both systems keeps two rows and two keys
    both = cust.where("full_name = 'Ada Moss'").select("source_system", "customer_sk").collect()
    assert sorted(r[0] for r in both) == ["a", "b"] and len({r[1] for r in both}) == 2


def test_unified_customers_business_rules(spark):
    cust = unify(INT_UNIFIED_CUSTOMERS, _staged(spark), loaded_at=False)
    rows = {(r["source_system"], r["source_customer_id"]): r for r in cust.collect()}
    assert rows[("a", "1")]["full_name"] == "Ada Moss"
    assert rows[("a", "1")]["status"] == "active"               # default for source a
    assert rows[("b", "2")]["status"] == "inactive"             # b passes through
    assert rows[("b", "3")]["first_name"] == "Cleo" and rows[("b", "3")]["last_name"] is None
    assert rows[("b", "4")]["last_name"] == "Pike Jr"
    assert "loaded_at" not in cust.columns


def test_unified_products_alignment(spark):
    prod = unify(INT_UNIFIED_PRODUCTS, _staged(spark), loaded_at=False)
    types = dict(prod.dtypes)
    assert types["unit_cost"] == "double" and types["stock_quantity"] == "bigint"
    a = prod.where("source_system = 'a'").collect()
    assert all(r["unit_cost"] is None for r in a)
    assert {r["source_product_id"]: r["is_available"] for r in a}["3"] is False   # stock -1
    b = prod.where("source_system = 'b'").collect()
    assert all(r["stock_quantity"] is None for r in b)


def test_loaded_at_is_one_value_per_build(spark):
    cust = unify(INT_UNIFIED_CUSTOMERS, _staged(spark))
    assert cust.select("loaded_at").distinct().count() == 1
    fixed = unify(INT_UNIFIED_CUSTOMERS, _staged(spark),
                  loaded_at=F.lit(dt.datetime(2024, 5, 1, 12, 0)))
    assert fixed.select("loaded_at").distinct().first()[0] == dt.datetime(2024, 5, 1, 12, 0)


def test_unify_is_narrow_and_prunes_branches(spark):
    from tests.conftest import SF_SMALL
    df = build.unified_from_tables(spark, SF_SMALL, "int_unified_activity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    pruned = df.where(F.col("source_system") == "events").select("activity_sk")
    p2 = pruned._jdf.queryExecution().executedPlan().toString()
    assert p2.count("FileScan") == 1 and "events.parquet" in p2
    # column pruning reaches the scan
    assert "ReadSchema: struct<event_id:bigint>" in p2


def test_staging_is_one_projection_per_raw_table():
    assert len(STAGING) == 7
    assert {m.raw_name for m in STAGING.values()} >= {
        "raw_a__contacts", "raw_a__inventory", "raw_b__customers", "raw_b__products"}
