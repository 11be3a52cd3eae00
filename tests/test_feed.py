"""Change feed over published epochs, and copies that consumers build from it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from unilake.plans.layers import Publisher
from unilake.plans.models import UNIFIED
from unilake.session import fresh_dir
from unilake.streaming.feed import read_change_log, read_copy, start_change_feed, start_change_log, start_copy

MODEL = UNIFIED["int_unified_customers"]


def rows(df):
    """Content; the load stamp is no content (a copy's is that of the row's last change)."""
    return sorted(map(tuple, df.select(MODEL.content_columns).collect()), key=str)


def publish_three(spark, lake):
    """Epochs 1 (b short and all active), 2 (b as it is), 3 (b lost rows, a unchanged)."""
    pub, b = Publisher(lake), fixtures.customers(spark)
    lake.land_many({"a": {"contacts": fixtures.contacts(spark)},
                    "b": {"customers": b.where("cust_id % 3 <> 0").withColumn("status", F.lit("active"))}})
    yield pub, pub.publish(MODEL).epoch
    lake.land("b", {"customers": b})
    yield pub, pub.publish(MODEL).epoch
    lake.land("b", {"customers": b.where("cust_id % 2 = 0")})
    yield pub, pub.publish(MODEL).epoch


def run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def test_copy_follows_every_epoch(spark, lake):
    path = fresh_dir(spark, "copy")
    for pub, _ in publish_three(spark, lake):
        run(start_copy(pub, MODEL, path, available_now=True))
        assert rows(read_copy(pub, path)) == rows(pub.read(MODEL))


def test_late_consumer_gets_all_epochs_once(spark, lake):
    for pub, epoch in publish_three(spark, lake):
        pass
    copy, log = fresh_dir(spark, "copy"), fresh_dir(spark, "log")
    run(start_copy(pub, MODEL, copy, available_now=True))
    assert rows(read_copy(pub, copy)) == rows(pub.read(MODEL))
    for _ in range(2):   # a second run finds nothing new
        run(start_change_log(pub, MODEL, log, available_now=True))
        got = read_change_log(pub, log).groupBy("epoch", "change_type").count().collect()
    per = {(r["epoch"], r["change_type"]): r["count"] for r in got}
    b = fixtures.customers(spark)
    n = lambda cond: b.where(cond).count()
    assert per == {k: v for k, v in {
        (1, "insert"): 12 + n("cust_id % 3 <> 0"), (2, "insert"): n("cust_id % 3 = 0"),
        (2, "update"): n("cust_id % 3 <> 0 and status <> 'active'"), (3, "delete"): n("cust_id % 2 <> 0")}.items() if v}


def test_a_failing_consumer_gets_the_epoch_again(spark, lake):
    for pub, _ in publish_three(spark, lake):
        pass
    checkpoint, seen = fresh_dir(spark, "feed"), []

    def handler(changes, epoch):
        seen.append((epoch, sorted(map(tuple, changes.select("customer_sk", "change_type").collect()))))
        if epoch == 2 and len(seen) == 2:
            raise RuntimeError("consumer lost")

    with pytest.raises(Exception, match="consumer lost"):
        run(start_change_feed(pub, MODEL, handler, checkpoint, available_now=True))
    run(start_change_feed(pub, MODEL, handler, checkpoint, available_now=True))
    assert [e for e, _ in seen] == [1, 2, 2, 3] and seen[1] == seen[2]


def test_no_epoch_yet(spark, lake):
    with pytest.raises(FileNotFoundError):
        start_copy(Publisher(lake), MODEL, fresh_dir(spark, "copy"))
