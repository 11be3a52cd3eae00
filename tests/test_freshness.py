"""Measured freshness: the ledger of a running refresh stream, and its batching."""

from __future__ import annotations

import datetime as dt
import itertools
import time

from tests import fixtures
from unilake.plans import queries
from unilake.plans.layers import Publisher
from unilake.plans.models import RAW_CONTRACTS, UNIFIED
from unilake.streaming.freshness import FreshnessListener, freshness_ledger, record_freshness
from unilake.streaming.refresh import start_stream_refresh

CUSTOMERS = UNIFIED["int_unified_customers"]


def _wait(cond, seconds=90):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if cond():
            return
        time.sleep(0.5)
    raise AssertionError("condition not reached in time")


def test_ledger_of_published_epochs(spark, lake):
    pub = Publisher(lake)
    assert record_freshness(pub, [CUSTOMERS]) == 0 and freshness_ledger(lake).count() == 0
    both = {"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": fixtures.customers(spark)}}
    lake.land_many(both)
    pub.publish(CUSTOMERS)
    lake.land("b", {"customers": fixtures.customers(spark).limit(2)})   # replaced before it is published
    lake.land("b", {"customers": fixtures.customers(spark)})
    pub.publish(CUSTOMERS)
    assert record_freshness(pub, [CUSTOMERS]) == 2
    assert record_freshness(pub, [CUSTOMERS]) == 0     # every epoch is entered once
    rows = freshness_ledger(lake).collect()
    assert sorted((r["epoch"], r["source"], r["load_id"], r["row_count"]) for r in rows) == [
        (1, "a", 1, 12), (1, "b", 1, 10), (2, "b", 2, 2), (2, "b", 3, 10)]
    for r in rows:
        assert abs((r["published_at"] - r["landed_at"]).total_seconds() - r["seconds"]) < 1e-3
        assert 0 < r["seconds"] and r["within_lag"] == (r["seconds"] <= 60) and r["target_lag"] == 60


def test_stream_enters_what_it_publishes(spark, lake):
    q = start_stream_refresh(lake, [CUSTOMERS], trigger="1 second", ledger=True)
    try:
        lake.land_many({"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": fixtures.customers(spark)}})
        _wait(lambda: freshness_ledger(lake).count() == 2)
    finally:
        q.stop()
    assert {(r["epoch"], r["source"]) for r in freshness_ledger(lake).collect()} == {(1, "a"), (1, "b")}


def test_listener_survives_and_ignores_other_queries(spark, lake):
    seen = []

    class Broken(FreshnessListener):
        @property
        def publisher(self):
            seen.append(1)
            raise RuntimeError("no lake")

        @publisher.setter
        def publisher(self, _):
            pass

    listener = Broken(Publisher(lake), [CUSTOMERS])
    listener.query_id = "one"
    listener._record("another")
    assert not seen
    listener._record("one")   # logged, not raised
    assert seen


def test_stream_by_deadline_publishes_loads_together(spark, lake):
    pub = Publisher(lake)
    both = {"a": {"contacts": fixtures.contacts(spark)}, "b": {"customers": fixtures.customers(spark)}}
    lake.land_many(both)
    pub.publish(CUSTOMERS)     # a measured build time; the lag of a minute leaves room to wait
    assert 0 < pub.pointer(CUSTOMERS).build_seconds < 25
    q = start_stream_refresh(lake, [CUSTOMERS], trigger="1 second", by_deadline=True, ledger=True)
    try:
        lake.land("b", {"customers": fixtures.customers(spark).limit(4)})
        lake.land("b", {"customers": fixtures.customers(spark)})
        _wait(lambda: pub.pointer(CUSTOMERS).versions.get("b") == 3, 120)
    finally:
        q.stop()
    assert pub.pointer(CUSTOMERS).epoch == 2     # one publication for both loads
    record_freshness(pub, [CUSTOMERS])
    rows = freshness_ledger(lake).where("epoch = 2").collect()
    assert sorted(r["load_id"] for r in rows) == [2, 3] and all(r["within_lag"] for r in rows)


def test_late_loads_are_entered_not_raised(spark, monkeypatch, tmp_path):
    for name in ("sales__orders", "sales__lineitem", "web__events"):   # five rows of each
        fields = RAW_CONTRACTS[f"raw_{name}"].fields
        spark.range(5).selectExpr(*[
            f"timestamp_ntz'2024-01-01 00:00:00' as {f.name}" if f.dataType.typeName() == "timestamp_ntz"
            else f"cast(id as {f.dataType.simpleString()}) as {f.name}" for f in fields]).write.parquet(
                f"{tmp_path}/{name.split('__')[1]}.parquet")
    new_lake, begin, hours = queries._new_lake, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), itertools.count()

    def slow(spark):   # whatever happens takes an hour
        lake = new_lake(spark)
        lake.clock = lambda: begin + dt.timedelta(hours=next(hours))
        return lake

    monkeypatch.setattr(queries, "_new_lake", slow)
    rows = queries.freshness_ledger(spark, str(tmp_path)).collect()
    assert sorted((r["epoch"], r["source"], r["load_id"], r["row_count"]) for r in rows) == [
        (1, "events", 1, 5), (1, "lineitem", 1, 5), (1, "orders", 1, 5), (2, "orders", 2, 5)]
    assert all(r["measured"] and not r["within_lag"] for r in rows)
