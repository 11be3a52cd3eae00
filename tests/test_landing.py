"""Raw landing: listing, naming, full replace, audit, missing sources (S1-S10)."""

from __future__ import annotations

import pytest

from tests import fixtures
from unilake.session import fresh_dir
from unilake.sources.landing import list_tables, raw_table_name, read_source, result_key


def _source_dir(spark, tables):
    root = fresh_dir(spark, "src")
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_naming_is_lower_case():
    assert raw_table_name("Sales", "Orders") == "raw_sales__orders"
    assert result_key("b", "Products") == "raw.raw_b__products"


def test_list_tables_excludes_internal_entries(spark):
    root = _source_dir(spark, {"users": spark.createDataFrame([("1", "x")], "id string, n string"),
                               "orders": spark.createDataFrame([("1",)], "id string")})
    spark.createDataFrame([(1,)], "seq int").write.parquet(f"{root}/_sequence")
    assert list(list_tables(spark, root)) == ["orders", "users"]
    assert sorted(read_source(spark, root)) == ["orders", "users"]


def test_land_from_a_source_folder_and_audit(spark, lake):
    big = spark.range(50).selectExpr("cast(id as string) as val")
    root = _source_dir(spark, {"big_table": big,
                               "things": spark.createDataFrame([], "id int, label string")})
    res = lake.land("src", root)
    assert res == {"raw.raw_src__big_table": 50, "raw.raw_src__things": 0}
    # the empty table keeps its schema
    things = lake.read_raw("raw_src__things")
    assert things.count() == 0 and things.columns == ["id", "label"]
    # the namespace exists before anything is written
    assert any(d.name == "raw" for d in spark.catalog.listDatabases())


def test_missing_source_is_skipped_not_raised(spark, lake):
    res = lake.land_many({"ghost": "/nonexistent/source/folder",
                          "a": {"contacts": fixtures.contacts(spark)}})
    assert res == {"raw.raw_a__contacts": 12}
    statuses = {r["source"]: r["status"] for r in lake.audit().collect()}
    assert statuses == {"ghost": "missing", "a": "loaded"}


def test_full_replace_changes_rows_and_schema(spark, lake):
    lake.land("b", {"items": spark.createDataFrame([("x",), ("y",), ("z",)], "sku string")})
    lake.land("b", {"items": spark.createDataFrame([("q", 1)], "sku string, qty int")})
    cur = lake.read_raw("raw_b__items")
    assert cur.count() == 1 and cur.columns == ["sku", "qty"]
    # the earlier load stays readable by id; the audit keeps both
    assert lake.read_raw("raw_b__items", 1).count() == 3
    assert sorted(r["load_id"] for r in lake.audit().collect()) == [1, 2]


def test_schema_comes_from_the_data(spark, lake):
    lake.land("a", {"contacts": fixtures.contacts(spark)})
    assert lake.read_raw("raw_a__contacts").schema == fixtures.contacts(spark).schema


def test_committed_load_is_never_rewritten(spark, lake):
    lake.land("a", {"t": spark.createDataFrame([("1",)], "id string")}, load_id=7)
    with pytest.raises(ValueError):
        lake.land("a", {"t": spark.createDataFrame([("2",)], "id string")}, load_id=7)
    assert [r["load_id"] for r in lake.audit().collect()] == [7]
    assert [r["id"] for r in lake.read_raw("raw_a__t").collect()] == ["1"]


def test_failed_write_raises_and_is_not_audited(spark, lake):
    from pyspark.sql import functions as F
    bad = spark.createDataFrame([("x",)], "v string").select(F.col("v").cast("int"))
    with pytest.raises(Exception):   # ANSI cast failure inside the write job
        lake.land("a", {"ok": spark.createDataFrame([("1",)], "id string"), "bad": bad})
    assert lake.audit().count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_raw("raw_a__ok")


def test_interrupted_load_leftovers_are_replaced(spark, lake):
    # an executor/driver died after writing part of load 1: files, no audit row
    spark.createDataFrame([("stale",)], "id string").write.parquet(
        lake.raw_path("raw_a__t", 1) + "/part-leftover")
    res = lake.land("a", {"t": spark.createDataFrame([("1",), ("2",)], "id string")})
    assert res == {"raw.raw_a__t": 2}
    assert sorted(r["id"] for r in lake.read_raw("raw_a__t").collect()) == ["1", "2"]


def test_compact_audit_keeps_every_row(spark, lake):
    for i in range(4):
        lake.land("a", {"t": spark.createDataFrame([(str(i),)], "id string")})
    before = sorted(tuple(r) for r in lake.audit().collect())
    assert lake.compact_audit() == 4
    assert sorted(tuple(r) for r in lake.audit().collect()) == before
    assert lake.compact_audit() == 0
    assert lake.current_loads()["raw_a__t"][0] == 4
    lake.land("a", {"t": spark.createDataFrame([("x",)], "id string")})
    assert lake.next_load_id() == 6


def test_land_from_a_catalog_database(spark, lake):
    from unilake.session import fresh_dir
    db_dir = fresh_dir(spark, "srcdb")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS src_catalog_test LOCATION '{db_dir}'")
    fixtures.contacts(spark).write.mode("overwrite").saveAsTable("src_catalog_test.contacts")
    spark.createDataFrame([(1,)], "seq int").write.mode("overwrite") \
        .saveAsTable("src_catalog_test._internal_seq")
    res = lake.land_many({"a": "catalog:src_catalog_test", "z": "catalog:no_such_db"})
    assert res == {"raw.raw_a__contacts": 12}
    assert {r["source"]: r["status"] for r in lake.audit().collect()} == {"a": "loaded",
                                                                        "z": "missing"}
