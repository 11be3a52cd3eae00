"""N-gram Jaccard join against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from unilake.llm import ngram_join, setkit
from unilake.llm.rtree import Roots
from tests.llm.conftest import SF


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                comp[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def planted(seed, n):
    """Texts with copies, small edits, shared passages and edge cases."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocab, k=60)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three four five"),
            (7, "ÀB c"), (8, "àb c"), (9, "x " * 3000), (10, "X\n" * 2999)]
    for i in range(11, n):
        kind = rng.random()
        if kind < 0.5 and len(rows) > 12:
            words = (rng.choice(rows)[1] or "").split() or ["a"]
            for _ in range(rng.choice([0, 1, 1, 2, 5, 20])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            if rng.random() < 0.3:
                words = words[:max(1, int(len(words) * rng.choice([0.7, 0.76, 0.8])))]
        else:
            words = rng.choices(vocab, k=rng.choice([3, 8, 30, 120, 400]))
            if rng.random() < 0.5:
                words = passage + words
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("task_tokens", [1 << 22, 600])
def test_matches_brute_force(make_docs, monkeypatch, task_tokens):
    monkeypatch.setattr(ngram_join, "TASK_TOKENS", task_tokens)
    rows = planted(task_tokens, 130)
    df = make_docs(rows).repartition(3)
    assert got(ngram_join.near_duplicates(df)) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(ngram_join.near_duplicates(docs)) == brute(rows)


def test_hot_group_of_near_copies(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK_TOKENS", 2000)
    rng = random.Random(3)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(80)] = f"own{i}"
        rows.append((i, " ".join(words)))
    out = got(ngram_join.near_duplicates(make_docs(rows)))
    assert out == brute(rows)


def by_row(rows, by_id=True):
    """n and component of every row: rows linked by words or (``by_id``) by their doc_id."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and (100 * len(x & y) >= 75 * len(x | y) or by_id and rows[a][0] is not None and rows[a][0] == rows[b][0]):
                comp[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i, find(k)) for k, (i, _) in enumerate(rows)]


def odd_ids():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choices(vocab, k=40)) for _ in range(12)]
    near = lambda t: t + " " + rng.choice(vocab)
    return [(None, texts[0]), (None, near(texts[0])), (2, texts[1]), (4, near(texts[1])), (None, near(texts[1])),
            (7, texts[2]), (7, texts[3]), (8, near(texts[3])), (9, near(texts[2])), (None, texts[4]), (None, texts[4]),
            (10, texts[5]), (10, texts[5]), (11, None), (11, texts[6]), (None, None), (12, ""), (13, texts[7]), (13, texts[7])]


@pytest.mark.parametrize("task_tokens", [1 << 22, 60])
def test_null_and_repeated_ids(make_docs, monkeypatch, task_tokens):
    monkeypatch.setattr(ngram_join, "TASK_TOKENS", task_tokens)
    rows = odd_ids()
    out = ngram_join.near_duplicates(make_docs(rows).repartition(4)).collect()
    assert Counter(tuple(r) for r in out) == Counter(r[:3] for r in by_row(rows))


def test_keep_one(make_docs):
    from pyspark.sql import functions as F
    rows = odd_ids()
    df = make_docs(rows).withColumn("node", F.lit(1)).withColumn("_gone_id", F.lit("x")).withColumn("first", F.lit(2))
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    out = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = {}
    for (i, t), (_, n, _, g) in zip(rows, by_row(rows, False), strict=True):
        if n:
            groups.setdefault(g, set()).add((i, t))
    for members in groups.values():   # one document of each group, with the smallest id
        stay = {r for r in out if r in members}
        assert len(stay) == 1
        assert (next(iter(stay))[0] is None) == all(i is None for i, _ in members)
        assert next(iter(stay))[0] == min((i for i, _ in members if i is not None), default=None)
    assert Counter(r for r in out if not shingles(r[1])) == Counter(r for r in rows if not shingles(r[1]))


def test_union_find_keeps_given_roots():
    roots = Roots(np.array([5, 7, 5, 9, 7]))
    assert roots.one(0) == roots.one(2) and roots.one(1) == roots.one(4) and not roots.join(0, 2)
    assert roots.join(0, 3) and roots.join(3, 4) and not roots.join(1, 2)
    assert len(set(roots.of(np.arange(5)).tolist())) == 1


def test_empty_table_and_clashing_columns(make_docs):
    from pyspark.sql import functions as F
    assert got(ngram_join.near_duplicates(make_docs([]))) == {}
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None)]
    df = make_docs(rows)
    for c in ("node", "n", "keys", "component_id", "island", "root", "task"):
        df = df.withColumn(c, F.lit("clash"))
    assert got(ngram_join.near_duplicates(df)) == brute(rows)


def test_bitmap_holds_all_values(spark):
    from pyspark.sql import functions as F
    ids = spark.range(1000).select((F.col("id") * 7).alias("doc_id"))
    mask = setkit.bitmap(ids, "doc_id", 1 << 16)
    slots = spark.range(14000).select(
        "id", setkit.hash_slot(F.col("id"), 1 << 16).alias("s")).toPandas()
    ok = setkit.passes(mask, slots["s"].to_numpy())
    assert ok[::7][:1000].all() and ok.mean() < 0.3


def together(island):
    """Sets of nodes that one island holds."""
    out = {}
    for r in island.collect():
        out.setdefault(r["component"], set()).add(r["node"])
    return list(out.values())


def test_documents_that_share_a_run_by_chance_stay_apart(make_docs):
    rng = random.Random(5)
    docs = [[f"d{i}w{k}" for k in range(200)] for i in range(60)]
    for i in range(59):
        for at in (20, 60, 100, 140):  # a run of five words each in this document and the next
            docs[i + 1][at + 10:at + 15] = docs[i][at:at + 5] = rng.choices("abcdefghijklmnop", k=5)
    docs.append(docs[30][:190] + [f"x{k}" for k in range(10)])
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    flat = np.zeros(1 << setkit.SKETCH_BITS, np.uint16)  # as loads are in a large corpus: all alike
    df = ngram_join.keyed(make_docs(rows).repartition(3))
    node = {r["doc_id"]: r["node"] for r in ngram_join.document_sets(df, flat, 0).collect()}
    assert together(setkit.islands(ngram_join._entries(df, flat, 0, 16))) == [{node[30], node[60]}]
    assert got(ngram_join.near_duplicates(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize("few", [1, 16])
def test_islands_hold_every_similar_pair(spark, monkeypatch, few):
    monkeypatch.setattr(setkit, "FEW", few)
    rng = np.random.default_rng(few)
    sets = []
    for _ in range(25):
        base = rng.choice(1 << 40, int(rng.integers(3, 150)), replace=False)
        for _ in range(int(rng.integers(1, 12))):  # copies with up to a quarter of the tokens dropped or changed
            drop = int(rng.integers(0, len(base) // 4 + 1))
            new = rng.choice(1 << 40, int(rng.integers(0, drop + 1)), replace=False)
            sets.append(set(rng.permutation(base)[drop:].tolist()) | set(new.tolist()))
    h = np.array([x for s in sets for x in sorted(s)], np.uint64)
    o = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    got = setkit.routed_sets(h, o, len(sets), np.zeros(1 << setkit.SKETCH_BITS, np.uint16), 0)
    lens = np.diff(got["key_off"])
    entries = [r for half in (np.arange(len(sets)) % 2 == 0, np.arange(len(sets)) % 2 == 1) for b in setkit.packed_entries(
        [(got["keys"][np.repeat(half, lens)], np.repeat(got["node"], lens * half), np.repeat(got["n"], lens * half))], 4)
        for r in zip(*b.to_pydict().values(), strict=True)]
    holds = together(setkit.islands(spark.createDataFrame(entries, setkit.ENTRY_SCHEMA)))
    at = {x: k for k, nodes in enumerate(holds) for x in nodes}
    node, linked = got["node"].tolist(), 0
    for i, x in enumerate(sets):
        for j in range(i):
            if 4 * len(x & sets[j]) >= 3 * len(x | sets[j]) and node[i] != node[j]:
                linked += 1
                assert at[node[i]] == at[node[j]]
    assert linked > 50
