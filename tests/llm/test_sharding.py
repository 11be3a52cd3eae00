"""Minimax shards against a plain partition of the same groups."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from unilake.llm import sharding


def least_capacity(sizes, shards):
    """Smallest capacity by trying every one that a stretch of groups can have."""
    def needed(c):
        used, left = 0, 0
        for s in sizes:
            if s > c:
                return shards + 1
            if s > left:
                used, left = used + 1, c
            left -= s
        return used

    sums = {sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)}
    return min(c for c in sums if needed(c) <= shards)


def check(rows, got, shards):
    """``rows``: (doc_id, text).  Every promise of the result, from the rows alone."""
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    slots, sizes, of_text = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        of_text[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards)) and all(len(s) == 1 for s in of_text.values())
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    order = sorted(groups, key=lambda t: min(-1 if i is None else i for i in groups[t]))
    assert max(sizes.values()) == least_capacity([len(groups[t]) * (len(t.encode()) + 1) for t in order], shards)
    # contiguous in the groups' order
    shard = {r["doc_id"]: r["shard"] for r in got}
    seen = [shard[min(groups[t], key=lambda i: -1 if i is None else i)] for t in order]
    assert seen == sorted(seen)
    return sizes


@pytest.mark.parametrize("shards, held", [(1, 0), (3, 0), (16, 1 << 14)])
def test_cases(spark, make_docs, monkeypatch, shards, held):
    monkeypatch.setattr(sharding, "HELD", held)
    rng = random.Random(shards)
    rows = [(1, None), (2, ""), (3, "é" * 50), (3, "other"), (None, "no id"), (4, "x" * 30000), (5, "no id")]
    rows += [(i, "".join(rng.choices("abcd ", k=rng.randint(0, 300)))) for i in range(10, 90)]
    rows += [(i, "copy of one text") for i in range(100, 160)]
    docs = make_docs(rows).repartition(5).withColumn("shard", F.lit("x")).withColumn("sha", F.lit(1)) \
        .withColumn("end", F.lit(0)).withColumn("run", F.lit(0))
    check(rows, sharding.shard_documents(docs, shards).collect(), shards)


def test_near_equal_without_heavy_groups(make_docs):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.randint(50, 150)))) for i in range(800)]
    sizes = check(rows, sharding.shard_documents(make_docs(rows)).collect(), 16)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 2 * 151


def test_a_group_of_a_third_of_all_bytes(make_docs):
    rows = [(i, f"text number {i} " * 3) for i in range(300)] + [(1000 + i, "hot " * 10) for i in range(200)]
    sizes = check(rows, sharding.shard_documents(make_docs(rows).repartition(6)).collect(), 16)
    assert len(sizes) == 16  # no shard is left empty by the heavy one
    rest = sorted(sizes.values())[:-1]
    assert rest[-1] <= 2 * rest[1]


def test_empty_and_table(spark, make_docs):
    assert sharding.shard_documents(make_docs([])).collect() == []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, sharding.shard_documents(docs).collect(), 16)


def test_plan_has_no_python(spark, make_docs):
    plan = sharding.shard_documents(make_docs([(1, "a"), (2, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
