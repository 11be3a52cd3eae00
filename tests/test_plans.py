"""Plan shapes of the shuffle operators, lenient staging, the end-to-end build."""

from __future__ import annotations

from tests import fixtures
from tests.conftest import SF_SMALL
from unilake.operators import quality
from unilake.operators.change_set import change_set
from unilake.operators.mapping import date_reject_counts, stage
from unilake.plans import build
from unilake.plans.models import STG_B_CUSTOMERS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_checks_are_one_partial_aggregate(spark):
    df = build.unified_from_tables(spark, SF_SMALL, "int_unified_activity", loaded_at=False)
    from unilake.plans.models import INT_UNIFIED_ACTIVITY
    p = _plan(quality.row_checks(df, "m", INT_UNIFIED_ACTIVITY.tests))
    assert p.count("HashAggregate") == 2            # partial + final
    assert "SinglePartition" in p and "hashpartitioning" not in p


def test_change_set_is_one_hash_shuffle_no_join(spark):
    df = build.unified_from_tables(spark, SF_SMALL, "int_unified_activity", loaded_at=False)
    cs = change_set(df, df, ["source_system", "activity_sk"])
    p = _plan(cs)
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_count_if" in p or "partial_count" in p   # map-side combine


def test_lenient_dates_and_reject_counts(spark):
    from pyspark.sql import functions as F
    raw = fixtures.customers(spark).withColumn(
        "signup_date", F.when(F.col("cust_id") == 2, F.lit("2024-13-45")).otherwise(F.col("signup_date")))
    staged = stage(raw, STG_B_CUSTOMERS, lenient_dates=True)
    assert staged.where("created_at is null").count() == 1
    assert date_reject_counts(raw, STG_B_CUSTOMERS).first()["created_at"] == 1


def test_end_to_end_build_matches_reference_shape(spark, lake):
    from unilake.plans.run import build_all
    summary = build_all(lake, fixtures.sources(spark),
                        models=["int_unified_customers", "int_unified_products"])
    got = {(r["layer"], r["table_name"]): r["row_count"] for r in summary.collect()}
    assert len([k for k in got if k[0] == "raw"]) == 4
    assert got[("intermediate", "int_unified_customers")] == 22
    assert got[("intermediate", "int_unified_products")] == 21
    cols = set(spark.table("intermediate.int_unified_customers").columns)
    assert {"customer_sk", "source_system", "source_customer_id", "full_name", "email",
            "status"} <= cols


def test_shuffles_are_sized_from_the_frames(spark):
    from unilake.session import size_shuffles
    now = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, spark.range(1000)) == int(now)
        big = spark.range(10**12)   # 8 TB by estimate
        assert size_shuffles(spark, big) > 1000
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", now)


def test_scale_conf_sizes_shuffles_by_shuffled_bytes():
    from unilake.session import scale_conf
    big = scale_conf(100 * 2**40, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 81920
    assert big["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    small = scale_conf(10 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16     # two waves of cores
