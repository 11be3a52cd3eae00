"""Data tests find planted violations; the gate blocks publication (T1-T5)."""

from __future__ import annotations

import pytest

from unilake.operators import quality
from unilake.operators.quality import accepted_values, not_null, unique


def _report(spark, df, checks, two_phase=True):
    rep = quality.run_checks(spark, [("m", df, checks)], two_phase=two_phase)
    return {(r["column_name"], r["check_name"]): (r["failures"], r["passed"])
            for r in rep.collect()}


def test_planted_violations_are_counted(spark):
    df = spark.createDataFrame(
        [("1", "a", "active"), ("2", None, "gone"), ("2", "b", None), ("3", "c", "churned"),
         (None, "d", "active"), (None, "e", "bogus")], "id string, name string, status string")
    rep = _report(spark, df, [unique("id"), not_null("id"), not_null("name"),
                              accepted_values("status", ["active", "inactive", "churned"])])
    assert rep[("id", "unique")] == (1, False)          # '2' twice; NULLs ignored
    assert rep[("id", "not_null")] == (2, False)
    assert rep[("name", "not_null")] == (1, False)
    assert rep[("status", "accepted_values")] == (2, False)   # NULL ignored


def test_clean_data_passes_and_gate_is_quiet(spark):
    df = spark.createDataFrame([("1", "active"), ("2", "churned")], "id string, status string")
    rep = quality.run_checks(spark, [("m", df, [unique("id"), not_null("id"),
                                                accepted_values("status", ["active", "churned"])])])
    assert quality.gate(rep) == []


def test_gate_raises_with_details(spark):
    df = spark.createDataFrame([("1",), ("1",)], "id string")
    rep = quality.run_checks(spark, [("m", df, [unique("id")])])
    with pytest.raises(quality.QualityGateError) as e:
        quality.gate(rep)
    assert e.value.failed == [("m", "id", "unique", 1)]


def test_unique_hot_key_and_two_phase_equals_exact(spark):
    # one value holds a third of all rows; a few other duplicates
    from pyspark.sql import functions as F
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") < 10, F.lit("dup"))
         .otherwise(F.col("id").cast("string")).alias("k"))
    exact = quality.unique_failures(df, "k", two_phase=False)
    assert exact == 2
    assert quality.unique_failures(df, "k", two_phase=True) == 2


def test_unique_all_distinct_skips_second_phase(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as k")
    assert quality.unique_failures(df, "k") == 0


def test_declared_test_inventory():
    from unilake.plans.models import (INT_UNIFIED_CUSTOMERS, INT_UNIFIED_PRODUCTS, STG_A_CONTACTS,
                                      STG_A_INVENTORY, STG_B_CUSTOMERS, STG_B_PRODUCTS)
    ms = [STG_A_CONTACTS, STG_A_INVENTORY, STG_B_CUSTOMERS, STG_B_PRODUCTS,
          INT_UNIFIED_CUSTOMERS, INT_UNIFIED_PRODUCTS]
    kinds = [t.kind for m in ms for t in m.tests]
    assert kinds.count("not_null") == 27
    assert kinds.count("unique") == 6
    assert kinds.count("accepted_values") == 4


def test_row_checks_observed_on_unique_scan_with_duplicates(spark):
    # duplicates force the second phase; metrics must come from the first scan only
    df = spark.createDataFrame([("1", None), ("1", "x"), ("2", "y"), (None, "z")],
                               "id string, name string")
    rep = _report(spark, df, [unique("id"), not_null("id"), not_null("name")])
    assert rep[("id", "unique")] == (1, False)
    assert rep[("id", "not_null")] == (1, False)
    assert rep[("name", "not_null")] == (1, False)


def test_unique_plan_has_one_full_shuffle_for_a_hot_duplicate(spark):
    from pyspark.sql import functions as F
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit("hot"))
                                  .otherwise(F.col("id").cast("string")).alias("k"))
    assert quality.unique_failures(df, "k") == 1
    counted = df.groupBy("k").count().where("count > 1")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
