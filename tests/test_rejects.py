"""Rows that fail a row test, kept beside the published version."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from unilake.operators.quality import QualityGateError
from unilake.plans.layers import Publisher, rejected_rows
from unilake.plans.models import UNIFIED

MODEL = UNIFIED["int_unified_customers"]


def broken(spark):
    return fixtures.customers(spark).withColumn("status", F.expr("if(cust_id = 3, 'gone', status)")) \
        .withColumn("signup_date", F.expr("if(cust_id in (3, 5), null, signup_date)"))


def test_offending_rows_stay_beside_the_version(spark, lake):
    lake.land_many({"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": broken(spark)}})
    with pytest.raises(QualityGateError):
        Publisher(lake).publish(MODEL)
    pub = Publisher(lake, keep_rejects=True)
    res = pub.publish(MODEL)
    assert res.rejected == {"a": 0, "b": 2}
    ids = [r["source_customer_id"] for r in pub.read(MODEL).where("source_system = 'b'").collect()]
    assert len(ids) == 8 and "3" not in ids and "5" not in ids
    assert spark.table("intermediate.int_unified_customers").count() == 20
    got = sorted((r["source_customer_id"], r["model"], r["check_name"], r["column_name"])
                 for r in rejected_rows(pub, MODEL).collect())
    assert got[0] == ("3", "int_unified_customers", "accepted_values", "status")
    assert {g[0] for g in got} == {"3", "5"} and ("5", "stg_b__customers", "not_null", "created_at") in got
    assert [r["failures"] for r in pub.check(MODEL, res.versions).where("failures > 0").collect()] == []
    # reading the published rows lists no file of the rejected ones
    files = pub.stored_rows(pub.version_path(MODEL, "b", 1)).inputFiles()
    assert any("rejected=1" in f for f in spark.read.parquet(pub.version_path(MODEL, "b", 1)).inputFiles()) and files
    plan = pub.stored_rows(pub.version_path(MODEL, "b", 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan


def test_all_rows_rejected_and_none(spark, lake):
    lake.land_many({"b": {"customers": fixtures.customers(spark).withColumn("status", F.lit("gone"))}})
    pub = Publisher(lake, keep_rejects=True)
    assert pub.publish(MODEL).rejected == {"b": 10}
    assert pub.read(MODEL).count() == 0 and spark.table("intermediate.int_unified_customers").count() == 0
    lake.land("b", {"customers": fixtures.customers(spark)})
    assert pub.publish(MODEL).rejected == {"b": 0}
    assert pub.read(MODEL).count() == 10 and rejected_rows(pub, MODEL).count() == 0
