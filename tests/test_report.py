"""Readouts: counts, preview, describe, contracts, tolerant summary (G1-G4, S12)."""

from __future__ import annotations

from tests import fixtures
from unilake.operators import report
from unilake.operators.unify import unify
from unilake.plans import build
from unilake.plans.models import INT_UNIFIED_CUSTOMERS, RAW_CONTRACTS, REQUIRED_COLUMNS


def _customers(spark):
    return unify(INT_UNIFIED_CUSTOMERS, build.staged_frames(fixtures.raw_tables(spark)))


def test_layer_summary_counts(spark):
    raw = fixtures.raw_tables(spark)
    got = {(r["layer"], r["table_name"]): r["row_count"] for r in report.layer_summary(
        [("raw", n, df) for n, df in raw.items()]
        + [("intermediate", "int_unified_customers", _customers(spark))]).collect()}
    assert got[("raw", "raw_a__contacts")] == 12
    assert got[("intermediate", "int_unified_customers")] == 22
    assert len([k for k in got if k[0] == "raw"]) == 4


def test_preview_is_ordered_top_n(spark):
    df = _customers(spark)
    top = report.preview(df, ["customer_sk"], 5)
    keys = [r["customer_sk"] for r in top.collect()]
    assert keys == sorted(r[0] for r in df.select("customer_sk").collect())[:5]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_describe_has_types_and_comments(spark):
    rows = report.describe(spark, [("c", _customers(spark))]).collect()
    d = {r["column_name"]: r for r in rows}
    assert d["customer_sk"]["data_type"] == "VARCHAR" and d["customer_sk"]["ordinal"] == 1
    assert d["created_at"]["data_type"] == "DATE"
    assert d["status"]["comment"] == "State of the account (see STATUS_VALUES)"


def test_required_columns_present():
    from pyspark.sql.types import StructType
    for model, cols in REQUIRED_COLUMNS.items():
        from unilake.plans.models import UNIFIED
        assert report.missing_required(UNIFIED[model].schema, cols) == []
    assert report.missing_required(StructType([]), ["a"]) == ["a"]


def test_contract_check_flags_drift(spark):
    from pyspark.sql import functions as F
    contacts = (fixtures.contacts(spark).drop("phone")
                .withColumn("extra", F.col("contact_id"))
                .withColumn("created_date", F.col("contact_id")))
    rows = report.contract_check(spark, [("raw_a__contacts", contacts.schema,
                                          RAW_CONTRACTS["raw_a__contacts"])]).collect()
    st = {r["column_name"]: r["status"] for r in rows}
    assert st["phone"] == "missing" and st["extra"] == "extra"
    assert st["created_date"] == "type_mismatch" and st["first_name"] == "ok"


def test_tolerant_summary_warns_instead_of_failing(spark):
    rows = report.tolerant_summary(spark, [
        ("intermediate", "good", lambda: spark.range(3)),
        ("intermediate", "bad", lambda: spark.read.parquet("/nonexistent/table")),
    ]).collect()
    st = {r["table_name"]: (r["status"], r["row_count"]) for r in rows}
    assert st == {"good": ("ok", 3), "bad": ("unreadable", None)}
