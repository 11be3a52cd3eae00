"""Hard negatives against plain comparison of all rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import SF
from unilake.llm import hard_negatives as hn
from unilake.llm import queries

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def truth(rows, anchor=lambda i: i % 5 == 0, label=lambda i, c: c, positives=5, negatives=10, least=30, most=90):
    good = []
    for i, v, c in rows:
        if i is None or c is None or not v or any(x is None or not math.isfinite(x) or math.isinf(256 * x) for x in v):
            continue
        good.append((i, [math.floor(256 * x) for x in v], label(i, c)))

    def clip(s):
        return min(max(s, -(1 << 63)), (1 << 63) - 1)

    out = []
    for n, (i, v, c) in enumerate(good):
        if not anchor(i):
            continue
        others = [(clip(sum(a * b for a, b in zip(v, w, strict=True))), j, d) for m, (j, w, d) in enumerate(good)
                  if m != n and len(w) == len(v)]
        others.sort(key=lambda t: (-t[0], t[1]))
        for ps, j, _ in [t for t in others if t[2] == c][:positives]:
            some = [t for t in others if t[2] != c and least * ps <= 100 * t[0] <= most * ps][:negatives]
            out += [(i, j, r, k, ps, ns) for r, (ns, k, _) in enumerate(some, 1)]
    return Counter(out)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(None, [1.0, 2.0], 1), (5, None, 1), (10, [1.0, None], 1), (15, [float("nan"), 1.0], 1), (20, [1.0, 1.0], None),
            (25, [], 1), (30, [float("inf"), 0.0], 1), (35, [1e307, 1.0], 1), (40, [0.0, 0.0], 2), (45, [1.0, 2.0, 3.0], 2),
            (46, [1.0, 2.0, 3.5], 2), (47, [0.5, 1.0, 2.0], 3), (50, [1.0, 1.0], 4), (50, [1.0, 1.0], 4), (51, [1.0, 0.5], 5),
            (52, [1.0, 0.5], 5), (52, [1.0, 0.5], 5), (55, [-1.0, -0.1], 6), (56, [1.0, 0.0], 6), (60, [7.0, 1.0], 99),
            (65, [3e8, 4e8], 7), (66, [3e8, 3e8], 7), (67, [1e8, 3e8], 8), (70, [1e12, 1.0], 9), (71, [1e12, 2.0], 9)]
    rows += [(i, [rng.choice([0.25, 0.5, 1.0]), rng.choice([0.25, 0.5, 1.0])], rng.randint(0, 2)) for i in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("row", "v", "anchor", "score", "dim"):
        df = df.withColumn(c, F.lit("x"))
    got = Counter(tuple(r) for r in hn.mine(df, F.col("vec_id") % 5 == 0).collect())
    assert got == truth(rows) and len(got) > 100
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("block, busy", [(64, 16), (16384, 16384)])
def test_clustered_vectors(spark, monkeypatch, block, busy):
    """Groups with means of their own, where the bounds drop rows; one label holds half."""
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    monkeypatch.setattr(hn, "TILE_ROWS", busy)
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 1, (6, 32))
    rows = []
    for i in range(400):
        c = 0 if i % 2 else int(rng.integers(1, 6))
        v = centre[int(rng.integers(0, 6))] + rng.normal(0, 0.3, 32)
        rows.append((i, [float(x) for x in v], c))
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in hn.mine(df, F.col("vec_id") % 20 == 0).collect())
    assert got == truth(rows, lambda i: i % 20 == 0)


def test_bounds_hold_and_drop_rows():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (rng.normal(0, 0.2, (500, 64)) + rng.normal(0, 1, (500, 1))))
    levels, true = hn.summaries(x), x @ x[0]
    left = []
    for level in levels:
        low, high = hn.bounds(level, level[0])
        assert (low <= true).all() and (true <= high).all()
        best = hn.Best(5, -np.inf, np.inf)
        left.append(int(best.open(low, high).sum()))
    assert left[0] < 250 and left == sorted(left, reverse=True)


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = truth(rows, lambda i: i % 100 == 0, lambda i, c: (c + 1) % 10 if i % 7 == 0 else c)
    got = queries.op11_hard_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == want and want
