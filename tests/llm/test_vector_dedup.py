"""Near-duplicate vectors against brute force."""

import numpy as np
from pyspark.sql import types as T

from unilake.llm import vector_dedup
from tests.llm.conftest import SF

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType())])


def brute(rows):
    ids = [r[0] for r in rows]
    comp, n = {i: i for i in ids}, [0] * len(rows)

    def unit(v):
        if v is None or any(x is None for x in v):
            return None
        v = np.array(v, dtype=np.float32).astype(np.float64)
        return v / np.linalg.norm(v) if np.isfinite(v).all() and np.linalg.norm(v) > 0 else None

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    vs = [unit(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if vs[i] is not None and vs[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] \
                    and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] >= 0.98:
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(ids[i]), find(ids[j])))
                comp[b] = a
    return {ids[i]: (n[i], find(ids[i]), find(ids[i]) == ids[i]) for i in range(len(rows))}


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def clustered(seed, n, d=16):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(12, d))
    for i in range(n):
        c = centres[rng.integers(12)] + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.15, 3.0])
        rows.append((i * 3 + 1, [float(np.float32(x)) for x in c], int(rng.integers(2))))
    return rows


def test_clusters_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "SHARD", 70)
    rows = clustered(1, 260)
    assert got(vector_dedup.near_vectors(spark.createDataFrame(rows, VEC))) == brute(rows)


def test_edge_cases(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, one, 2), (5, one, None), (6, None, 1),
            (7, [0.0, 0.0, 0.0], 1), (8, [None, 1.0, 0.0], 1), (9, [float("nan"), 0.0, 1.0], 1),
            (10, [float("inf"), 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [], 1), (13, [1.0, 0.0], 1)]
    assert got(vector_dedup.near_vectors(spark.createDataFrame(rows, VEC))) == brute(rows)
    assert got(vector_dedup.near_vectors(spark.createDataFrame([], VEC))) == {}


def test_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert got(vector_dedup.near_vectors(df)) == brute(rows)


def test_graph_recall():
    x = np.random.default_rng(3).normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = vector_dedup.Graph(x)
    hits = 0
    for i in range(0, 1500, 20):  # every 20th row is a query
        want = set(np.argsort(-(x @ x[i]), kind="stable")[:10].tolist())
        hits += len(want & set(g.nearest(g.x[i], 64)[:10].tolist()))
    assert hits >= 0.9 * 75 * 10


def test_beams_widen_until_the_audit_passes(monkeypatch):
    monkeypatch.setattr(vector_dedup, "BEAM", 1)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(60, 8)), 5, axis=0) + rng.normal(size=(300, 8)) * 0.02
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = vector_dedup.search_block(vector_dedup.Graph(x), x, x, True)
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert sum(n for n, _ in out) >= 0.99 * want.sum()


class Blind:
    """A graph whose beams see the first rows of one group only."""

    def __init__(self, x, seen):
        self.x, self.seen = x.astype(np.float32), seen

    def nearest(self, q, beam):
        return self.seen[:beam]


def paired(rng, n, d=24):
    x = np.repeat(rng.normal(size=(n, d)), 2, axis=0) + rng.normal(size=(2 * n, d)) * 0.01
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_audit_is_not_outweighed_by_a_hot_group():
    rng = np.random.default_rng(8)
    pairs = paired(rng, 200)
    x = np.empty((800, 24))
    x[::2], x[1::2] = pairs[0], pairs  # half of the rows are copies of one
    out = vector_dedup.search_block(Blind(x, np.arange(0, 800, 2)), x, x, True)
    assert [n for n, _ in out] == ((x @ x.T >= 0.98).sum(axis=1) - 1).tolist()


def test_audit_without_a_link_in_its_first_rows():
    rng = np.random.default_rng(9)
    x = paired(rng, 150)
    q = rng.normal(size=(3000, 24))
    q[[1, 1201, 2999]] = x[[4, 100, 7]]
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    out = vector_dedup.search_block(Blind(x, np.arange(100, 50, -1)), x, q, False)
    assert [n for n, _ in out] == (q @ x.T >= 0.98).sum(axis=1).tolist()


def test_full_beam_reaches_a_second_group():
    rng = np.random.default_rng(10)
    basis = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    turn = lambda a: np.cos(a) * basis[0] + np.sin(a) * basis[1]
    far = rng.normal(size=(300, 24))
    x = np.vstack([np.repeat(turn(-0.05)[None], 40, axis=0), turn(0.19)[None],
                   far / np.linalg.norm(far, axis=1, keepdims=True)])
    q = np.vstack([turn(0.0), x[:40], x[:40], x[:40], x[:40], x[:40], x[:40]])
    out = vector_dedup.search_block(vector_dedup.Graph(x), x, q, False)
    assert [n for n, _ in out] == [41] + [40] * 240 and len(out[0][1]) == 2


def turned(degrees):
    a = np.radians(np.array(degrees, dtype=float))
    return np.stack([np.cos(a), np.sin(a)], axis=1)


def test_rows_that_no_beam_finds_are_linked(monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAST_RECALL", 0.0)   # the audit accepts any answer
    x = paired(np.random.default_rng(11), 300)
    out = vector_dedup.search_block(Blind(x, np.arange(100)), x, x, True)
    assert [n for n, _ in out] == ((x @ x.T >= 0.98).sum(axis=1) - 1).tolist()
    q = x[::-1]
    out = vector_dedup.search_block(Blind(x, np.arange(100)), x, q, False)
    assert [n for n, _ in out] == (q @ x.T >= 0.98).sum(axis=1).tolist()


def test_chain_out_of_order_is_one_component(spark):
    # links only between neighbours at 10 degrees; each row's first linked row is not enough
    rows = [(i, [float(v) for v in x], 1) for i, x in enumerate(turned([0, 30, 10, 20, 90, 110, 100]).tolist())]
    assert got(vector_dedup.near_vectors(spark.createDataFrame(rows, VEC).coalesce(1))) == brute(rows)


class Counted(vector_dedup.Graph):
    def nearest(self, q, beam):
        self.asked = getattr(self, "asked", 0) + 1
        return super().nearest(q, beam)


def test_own_block_is_searched_once_for_each_beam(monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAST_RECALL", 0.0)   # one beam is enough
    x = paired(np.random.default_rng(12), 200)
    g = Counted(x)
    out = vector_dedup.search_block(g, x, x, True)
    assert [n for n, _ in out] == ((x @ x.T >= 0.98).sum(axis=1) - 1).tolist()
    assert g.asked == len(x)


def test_search_starts_at_the_own_node():
    rng = np.random.default_rng(13)
    x = paired(rng, 200)
    g = vector_dedup.Graph(x)
    g.top, g.entry = 0, 0
    g.near[0][0] = np.zeros(0, np.int64)   # nothing is reached from the entry
    assert all({i, i ^ 1} <= set(g.nearest(g.x[i], 16).tolist()) for i in range(2, len(x)))
    assert g.nearest(rng.normal(size=24).astype(np.float32), 16).tolist() == [0]


def test_large_groups_in_other_blocks():
    rng = np.random.default_rng(14)
    x = np.vstack([np.repeat(paired(rng, 1)[:1], 150, axis=0), paired(rng, 60)])
    q = np.vstack([x[:40], paired(rng, 30), x[200:]])
    for same, other in ((True, x), (False, q)):
        out = vector_dedup.search_block(vector_dedup.Graph(x), x, other, same)
        assert [n for n, _ in out] == ((other @ x.T >= 0.98).sum(axis=1) - same).tolist()
