"""Publication, pointer swap, refresh (batch and streaming), change sets (R1-R4, M5, M6)."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from tests import fixtures
from unilake.operators.change_set import change_set
from unilake.operators.quality import QualityGateError
from unilake.plans.layers import Publisher, layer_name, register_raw_views, register_staging_views
from unilake.plans.models import INT_UNIFIED_CUSTOMERS
from unilake.streaming.refresh import (needs_refresh, overdue, parse_lag, snapshot_refresh,
                                       staleness, start_stream_refresh)

CUST = "int_unified_customers"


def _publish_initial(spark, lake):
    lake.land_many(fixtures.sources(spark))
    pub = Publisher(lake)
    res = pub.publish(CUST)
    return pub, res


def test_layer_routing():
    assert layer_name(None, " staging ") == "staging"
    assert layer_name(" intermediate ", "staging") == "intermediate"


def test_publish_then_refresh_rebuilds_only_changed_source(spark, lake):
    pub, res = _publish_initial(spark, lake)
    assert res.epoch == 1 and res.versions == {"a": 1, "b": 1}
    assert pub.read(CUST).count() == 22
    # second snapshot of b: two customers deleted, one renamed
    b2 = fixtures.customers(spark).where("cust_id > 2").withColumn(
        "full_name", F.when(F.col("cust_id") == 3, F.lit("Cleo Park")).otherwise(F.col("full_name")))
    lake.land("b", {"customers": b2})
    st = staleness(pub, CUST)
    assert [s["changed"] for s in st] == [False, True]
    assert needs_refresh(st)
    res2 = snapshot_refresh(pub, CUST)
    assert res2.rebuilt == ["b"] and res2.versions == {"a": 1, "b": 2}
    cur = pub.read(CUST)
    assert cur.count() == 20
    assert cur.where("source_customer_id = '3' and source_system = 'b'").first()["last_name"] == "Park"
    # the catalog view follows the pointer
    assert spark.table(f"intermediate.{CUST}").count() == 20


def test_replay_is_a_no_op(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    again = pub.publish(CUST)
    assert again.rebuilt == [] and again.epoch == 1


def test_empty_snapshot_removes_that_source_only(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    lake.land("b", {"customers": fixtures.customers(spark).limit(0)})
    snapshot_refresh(pub, CUST)
    cur = pub.read(CUST)
    assert cur.count() == 12 and {r[0] for r in cur.select("source_system").distinct().collect()} == {"a"}


def test_failed_gate_keeps_previous_state(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    bad = fixtures.customers(spark).withColumn("status", F.lit("unknown"))
    lake.land("b", {"customers": bad})
    with pytest.raises(QualityGateError):
        snapshot_refresh(pub, CUST)
    assert pub.pointer(INT_UNIFIED_CUSTOMERS).versions == {"a": 1, "b": 1}
    assert pub.read(INT_UNIFIED_CUSTOMERS).where("status = 'unknown'").count() == 0


def test_loaded_at_comes_from_the_audit(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    landed = {r["raw_table"]: r["landed_at"] for r in lake.audit().collect()}
    got = {r[0] for r in pub.read(CUST).where("source_system = 'a'").select("loaded_at").collect()}
    assert got == {landed["raw.raw_a__contacts"]}


def test_stream_refresh_two_loads_one_batch_restart_and_replay(spark, lake):
    lake.land_many(fixtures.sources(spark))
    lake.land("b", {"customers": fixtures.customers(spark).where("cust_id <= 5")})
    ckpt = f"{lake.root}/_checkpoints/test"
    q = start_stream_refresh(lake, [CUST], checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    pub = Publisher(lake)
    # both loads arrived in one micro-batch; only the newest is published
    assert pub.read(CUST).count() == 17
    epoch = pub.pointer(INT_UNIFIED_CUSTOMERS).epoch
    # restart from the checkpoint with nothing new: no new epoch
    q = start_stream_refresh(lake, [CUST], checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    assert pub.pointer(INT_UNIFIED_CUSTOMERS).epoch == epoch
    # an empty snapshot is a committed load too: the stream sees it
    lake.land("a", {"contacts": fixtures.contacts(spark).limit(0)})
    q = start_stream_refresh(lake, [CUST], checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    assert pub.read(CUST).count() == 5


def test_staleness_bound():
    assert parse_lag("1 minute") == 60 and parse_lag("30 seconds") == 30
    st = [{"changed": True, "waiting_seconds": 90.0}, {"changed": False, "waiting_seconds": 0.0}]
    assert overdue(st, "1 minute") and needs_refresh(st)
    assert not overdue([{"changed": True, "waiting_seconds": 10.0}], "1 minute")
    assert not needs_refresh([{"changed": False, "waiting_seconds": 0.0}])


def test_views_re_resolve_to_new_loads(spark, lake):
    lake.land("a", {"contacts": fixtures.contacts(spark)})
    register_raw_views(lake)
    register_staging_views(lake)
    assert spark.table("raw.raw_a__contacts").count() == 12
    lake.land("a", {"contacts": fixtures.contacts(spark).limit(3)})
    register_raw_views(lake)
    register_staging_views(lake)
    assert spark.table("raw.raw_a__contacts").count() == 3
    assert spark.table("stg_a__contacts").count() == 3


def test_change_set_semantics(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (5, "e", 5.0)],
                                "k long, v string, x double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (5, "e", 5.0)],
                                "k long, v string, x double")
    got = {r["k"]: r["change_type"] for r in change_set(old, new, ["k"]).collect()}
    assert got == {2: "update", 3: "delete", 4: "insert"}
    full = change_set(old, new, ["k"], include_unchanged=True, payload=True)
    rows = {r["k"]: r for r in full.collect()}
    assert rows[1]["change_type"] == "unchanged" and rows[4]["new_row"]["v"] == "d"
    assert rows[3]["new_row"] is None


def test_change_set_hot_duplicate_key(spark):
    # a key repeated in a third of all rows does not produce pairs
    old = spark.range(3000).selectExpr("case when id % 3 = 0 then 0 else id end as k",
                                       "'x' as v")
    new = old.where("k != 1")
    got = change_set(old, new, ["k"]).collect()
    assert [(r["k"], r["change_type"]) for r in got] == [(1, "delete")]


def test_gate_counts_are_stored_per_version_and_add_up(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    path = pub.version_path(INT_UNIFIED_CUSTOMERS, "b", 1)
    counts = pub._read_check_counts(path)
    assert counts["unique:customer_sk"] == 0 and counts["not_null:full_name"] == 0
    # duplicated ids inside one source are caught by the per-version count
    dup = fixtures.customers(spark).unionByName(fixtures.customers(spark).where("cust_id = 1"))
    lake.land("b", {"customers": dup})
    with pytest.raises(QualityGateError) as e:
        snapshot_refresh(pub, CUST)
    assert ("int_unified_customers", "customer_sk", "unique", 1) in e.value.failed
    # the candidate report (from the stored per-version counts) agrees
    rep = {(r["column_name"], r["check_name"]): r["failures"]
           for r in pub.check(INT_UNIFIED_CUSTOMERS, {"a": 1, "b": 2}).collect()}
    assert rep[("customer_sk", "unique")] == 1 and rep[("full_name", "not_null")] == 0


def test_stream_records_gate_failure_and_keeps_previous_state(spark, lake):
    from unilake.streaming.refresh import refresh_log
    pub, _ = _publish_initial(spark, lake)
    lake.land("b", {"customers": fixtures.customers(spark).withColumn("status", F.lit("bogus"))})
    q = start_stream_refresh(lake, [CUST], available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert pub.pointer(INT_UNIFIED_CUSTOMERS).versions == {"a": 1, "b": 1}
    logged = refresh_log(lake).collect()
    assert [(r["model"], r["status"]) for r in logged] == [(CUST, "gate_failed")]
    assert overdue(staleness(pub, CUST), target_lag=0)


def test_build_all_reports_gate_failures(spark, lake):
    from unilake.plans.run import build_all
    srcs = fixtures.sources(spark)
    srcs["b"]["customers"] = srcs["b"]["customers"].withColumn("status", F.lit("bogus"))
    rows = {r["table_name"]: r["status"] for r in build_all(
        lake, srcs, ["int_unified_customers", "int_unified_products"],
        on_gate_failure="report").collect()}
    assert rows["int_unified_customers"] == "gate_failed"
    assert rows["int_unified_products"] == "ok"


def test_published_changes_between_epochs_skip_unchanged_sources(spark, lake):
    from unilake.plans.layers import published_changes
    pub, first = _publish_initial(spark, lake)
    b2 = fixtures.customers(spark).where("cust_id != 2").withColumn(
        "email", F.when(F.col("cust_id") == 3, F.lit("new@b.example")).otherwise(F.col("email")))
    lake.land("b", {"customers": b2})
    second = snapshot_refresh(pub, CUST)
    ch = published_changes(pub, CUST, first.epoch, second.epoch)
    got = sorted((r["source_system"], r["change_type"]) for r in ch.collect())
    assert got == [("b", "delete"), ("b", "update")]
    # source a kept its version: its files are not part of the plan
    plan = ch._jdf.queryExecution().executedPlan().toString()
    assert "/a/v=" not in plan


def test_persistent_staging_views_follow_raw_loads(spark, lake):
    from unilake.operators.mapping import stage
    from unilake.plans.models import STAGING
    lake.land_many(fixtures.sources(spark))
    register_staging_views(lake, persistent=True)
    for name in ("stg_a__contacts", "stg_a__inventory", "stg_b__customers", "stg_b__products"):
        view = spark.table(f"staging.{name}")
        frame = stage(lake.read_raw(STAGING[name].raw_name), STAGING[name])
        assert view.schema.simpleString() == frame.schema.simpleString()
        assert sorted(view.collect()) == sorted(frame.collect())
    lake.land("b", {"products": fixtures.products(spark).limit(4)})
    register_raw_views(lake)          # repoint raw only; staging re-resolves
    assert spark.table("staging.stg_b__products").count() == 4


def test_interrupted_version_write_is_redone(spark, lake):
    lake.land_many(fixtures.sources(spark))
    pub = Publisher(lake)
    # a previous attempt died mid-write: files but no commit marker
    partial = pub.version_path(INT_UNIFIED_CUSTOMERS, "b", 1)
    spark.createDataFrame([("junk",)], "x string").write.parquet(partial + "/part-x")
    res = pub.publish(CUST)
    assert res.versions == {"a": 1, "b": 1}
    assert pub.read(CUST).count() == 22


def test_published_view_carries_comments(spark, lake):
    _publish_initial(spark, lake)
    rows = {r["col_name"]: r["comment"] for r in
            spark.sql(f"DESCRIBE TABLE intermediate.{CUST}").collect()}
    assert rows["customer_sk"].startswith("md5 key")
    assert rows["status"] == "State of the account (see STATUS_VALUES)"
    ext = spark.sql(f"DESCRIBE TABLE EXTENDED intermediate.{CUST}").collect()
    assert any("one row per (source, id)" in (r["data_type"] or "") for r in ext)


def test_vacuum_keeps_what_readers_need(spark, lake):
    pub, _ = _publish_initial(spark, lake)
    for n in (8, 6):
        lake.land("b", {"customers": fixtures.customers(spark).limit(n)})
        snapshot_refresh(pub, CUST)
    # versions b: 1, 2, 3 (epochs 1..3); keep the newest 2 epochs -> b v=1 goes
    gone = pub.vacuum(CUST, keep_epochs=2)
    assert [p.rsplit("/", 2)[-2:] for p in gone] == [["b", "v=1"]]
    assert pub.read(CUST).count() == 12 + 6
    # raw: keep the newest load of each table
    gone_raw = lake.vacuum_raw(keep_loads=1)
    assert sorted(p.rsplit("/", 1)[-1] for p in gone_raw) == ["load_id=1", "load_id=2"]
    assert lake.read_raw("raw_b__customers").count() == 6
    assert lake.read_raw("raw_a__contacts").count() == 12


def test_running_stream_publishes_new_loads_within_the_lag(spark, lake):
    import time
    lake.land_many(fixtures.sources(spark))
    q = start_stream_refresh(lake, [CUST], trigger="1 second")
    pub = Publisher(lake)
    try:
        def wait_for(n, timeout=120):
            t0 = time.time()
            while time.time() - t0 < timeout:
                if pub.pointer(INT_UNIFIED_CUSTOMERS).epoch >= n:
                    return time.time() - t0
                if q.exception() is not None:
                    raise AssertionError(str(q.exception()))
                time.sleep(0.5)
            raise AssertionError(f"epoch {n} not published within {timeout}s")
        wait_for(1)
        assert pub.read(CUST).count() == 22
        # a new upstream snapshot appears without any manual build step
        lake.land("b", {"customers": fixtures.customers(spark).limit(4)})
        latency = wait_for(2)
        assert latency < 60                     # within the 1-minute target lag
        assert pub.read(CUST).count() == 16
    finally:
        q.stop()


def test_stream_after_audit_compaction_is_a_no_op(spark, lake):
    lake.land_many(fixtures.sources(spark))
    lake.land("b", {"customers": fixtures.customers(spark).limit(5)})
    ckpt = f"{lake.root}/_checkpoints/compact"
    q = start_stream_refresh(lake, [CUST], checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    pub = Publisher(lake)
    epoch = pub.pointer(INT_UNIFIED_CUSTOMERS).epoch
    assert lake.compact_audit() == 2
    q = start_stream_refresh(lake, [CUST], checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert pub.pointer(INT_UNIFIED_CUSTOMERS).epoch == epoch
    assert pub.read(CUST).count() == 17


def test_published_changes_read_only_key_and_stored_hash(spark, lake):
    from unilake.plans.layers import ROW_HASH_COLUMN, published_changes
    pub, first = _publish_initial(spark, lake)
    assert ROW_HASH_COLUMN not in pub.read(CUST).columns
    assert ROW_HASH_COLUMN not in spark.table(f"intermediate.{CUST}").columns
    lake.land("b", {"customers": fixtures.customers(spark).withColumn(
        "email", F.when(F.col("cust_id") == 3, F.lit("z@b.example")).otherwise(F.col("email")))})
    second = snapshot_refresh(pub, CUST)
    ch = published_changes(pub, CUST, first.epoch, second.epoch)
    assert [(r["change_type"]) for r in ch.collect()] == ["update"]
    plan = ch._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<customer_sk:string,{ROW_HASH_COLUMN}:bigint>" in plan


def test_stream_refreshes_several_models_in_one_batch(spark, lake):
    lake.land_many(fixtures.sources(spark))
    q = start_stream_refresh(lake, ["int_unified_customers", "int_unified_products"],
                             available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    pub = Publisher(lake)
    assert pub.read("int_unified_customers").count() == 22
    assert pub.read("int_unified_products").count() == 21


def test_lenient_publication_counts_bad_dates(spark, lake):
    bad = fixtures.customers(spark).withColumn(
        "signup_date", F.when(F.col("cust_id") <= 2, F.lit("not-a-date"))
        .otherwise(F.col("signup_date")))
    lake.land_many({"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": bad}})
    with pytest.raises(Exception):            # strict (default): the build fails
        Publisher(lake).publish(CUST)
    res = Publisher(lake, lenient_dates=True).publish(CUST)
    # a's version was already committed by the strict attempt and is reused
    assert res.date_rejects == {"b.created_at": 2}
    rows = Publisher(lake).read(CUST).where("source_system = 'b' and created_at is null")
    assert rows.count() == 2
