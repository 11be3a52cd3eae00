"""Landing, gate, views, stamps and refresh: what must never be lost or misreported."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from unilake.operators.change_set import change_set
from unilake.operators.quality import QualityGateError
from unilake.plans.layers import Publisher, register_staging_views
from unilake.plans.run import build_all
from unilake.session import fresh_dir
from unilake.sources import adapters
from unilake.sources.landing import Lake, list_tables
from unilake.streaming.refresh import refresh_log, start_stream_refresh

CUST = "int_unified_customers"


def _sources(spark):
    return {"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": fixtures.customers(spark)}}


def test_undeclared_columns_are_landed(spark, lake):
    root = fresh_dir(spark, "drift")
    spark.range(3).selectExpr("cast(id as int) r_regionkey", "'n' new_col").write.parquet(f"{root}/region.parquet")
    assert adapters.read_table(spark, root, "region").columns == ["r_regionkey", "new_col"]


def test_colliding_names_are_refused_before_writing(spark, lake):
    one = spark.range(2).toDF("id")
    with pytest.raises(ValueError, match="raw_s__orders"):
        lake.land("s", {"Orders": one, "orders": one})
    assert lake.current_loads() == {}


def test_stray_files_are_no_tables(spark):
    root = fresh_dir(spark, "src")
    spark.range(1).write.parquet(f"{root}/t.parquet")
    with open(os.path.join(root.removeprefix("file:"), "README.txt"), "w") as f:
        f.write("x")
    assert list(list_tables(spark, root)) == ["t"]


def test_duplicate_keys_compare_as_multisets(spark):
    old = spark.createDataFrame([(1, x) for x in (1, 2, 5)] + [(2, x) for x in (7, 7, 8)], "k int, v int")
    new = spark.createDataFrame([(1, x) for x in (1, 3, 5)] + [(2, x) for x in (8, 7, 7)], "k int, v int")
    assert [tuple(r) for r in change_set(old, new, ["k"]).collect()] == [(1, "update")]


@pytest.mark.parametrize("column", ["signup_date", "status"])
def test_staging_tests_gate_publication(spark, lake, column):
    src = _sources(spark)
    lake.land_many(src)
    pub = Publisher(lake)
    first = pub.publish(CUST)
    lake.land("b", {"customers": src["b"]["customers"].withColumn(column, F.lit(None).cast("string"))})
    with pytest.raises(QualityGateError, match="stg_b__customers"):
        pub.publish(CUST)
    assert pub.pointer(pub_model()).epoch == first.epoch


def pub_model():
    from unilake.plans.models import UNIFIED
    return UNIFIED[CUST]


def test_build_creates_staging_and_landing_repoints(spark, lake):
    build_all(lake, _sources(spark), [CUST])
    assert spark.table("staging.stg_b__customers").count() == 10
    lake.land("b", {"customers": fixtures.customers(spark).limit(3)})
    assert spark.table("staging.stg_b__customers").count() == 3
    said = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE staging.stg_b__customers").collect()}
    assert said["phone_number"] == "Mobile number on file, if any"
    extended = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED raw.raw_b__customers").collect()}
    assert "Load 2" in extended["Comment"]


def test_publish_repairs_a_missing_view(spark, lake):
    lake.land_many(_sources(spark))
    pub = Publisher(lake)
    pub.publish(CUST)
    spark.sql(f"DROP VIEW intermediate.{CUST}")
    assert pub.publish(CUST).rebuilt == []
    assert spark.table(f"intermediate.{CUST}").count() == 22


def test_namespaces_belong_to_one_lake(spark, lake):
    lake.land_many(_sources(spark))
    other = Lake(spark, fresh_dir(spark, "other"))
    with pytest.raises(ValueError, match="namespace"):
        other.land_many(_sources(spark))
    named = Lake(spark, fresh_dir(spark, "named"), namespace="n2_")
    named.land("a", {"contacts": fixtures.contacts(spark).limit(2)})
    register_staging_views(named, persistent=True)
    assert spark.table("n2_staging.stg_a__contacts").count() == 2
    assert spark.table("raw.raw_a__contacts").count() == 12
    for layer in ("raw", "staging", "intermediate"):
        spark.sql(f"DROP SCHEMA IF EXISTS n2_{layer} CASCADE")


def test_stream_survives_a_poisoned_load(spark, lake):
    bad = fixtures.customers(spark).withColumn("signup_date", F.lit("not-a-date"))
    lake.land_many({"a": {"contacts": fixtures.contacts(spark), "inventory": fixtures.inventory(spark)},
                    "b": {"customers": bad, "products": fixtures.products(spark)}})
    start_stream_refresh(lake, [CUST, "int_unified_products"], available_now=True).awaitTermination()
    assert [r["status"] for r in refresh_log(lake).collect()] == ["failed"]
    assert Publisher(lake).read("int_unified_products").count() == 21
    start_stream_refresh(lake, [CUST], available_now=True, lenient_dates=True,
                         checkpoint=f"{lake.root}/_checkpoints/lenient").awaitTermination()
    assert Publisher(lake).read(CUST).count() == 22


def test_stamps_are_utc_whatever_the_drivers_zone():
    code = """
import datetime as dt
from unilake.session import build_session, fresh_dir
from unilake.sources.landing import Lake
spark = build_session("local[1]")
lake = Lake(spark, fresh_dir(spark, "tz"))
lake.land("s", {"t": spark.range(1).toDF("id")})
at = spark.sql(f"select unix_seconds(landed_at) from parquet.`{lake.audit_path}`").first()[0]
assert abs(at - dt.datetime.now(dt.timezone.utc).timestamp()) < 300, at
assert abs((lake.current_loads()["raw_s__t"][1] - dt.datetime.now(dt.timezone.utc)).total_seconds()) < 300
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200, cwd=fresh_cwd(),
                   env=os.environ | {"TZ": "America/New_York", "PYTHONPATH": root})


def fresh_cwd() -> str:
    import tempfile
    return tempfile.mkdtemp(prefix="unilake-test-")
