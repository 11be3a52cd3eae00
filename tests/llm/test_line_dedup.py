"""Line dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from unilake.llm import line_dedup, setkit
from tests.llm.conftest import SF
from tests.llm.test_ngram_join import shingles, together


def digest(text):
    """Signed 64-bit digest of a text, which orders rows that repeat a doc_id."""
    n = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return n - (1 << 64) if n >= 1 << 63 else n


def brute_rows(rows):
    """(doc_id, text, n_lines, removed) of every row; equal rows are one document."""
    seen, out = [], {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1]))):
        lines = [] if t is None else t.split("\n")
        gone = []
        for k, line in enumerate(lines):
            s = shingles(line)
            if not s:
                continue
            if any(100 * len(s & o) >= 75 * len(s | o) for o in seen):
                gone.append(k)
            seen.append(s)
        out[(i, t)] = (i, None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), tuple(gone))
    return Counter(out[r] for r in rows)


def brute(rows):
    return {i: (t, n, list(gone)) for i, t, n, gone in brute_rows(rows)}


def got(df):
    return {r["doc_id"]: (r["text"], r["n_lines"], list(r["removed_lines"])) for r in df.collect()}


def rows_of(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    pool = [" ".join(rng.choices(vocab, k=rng.choice([2, 7, 30, 60]))) for _ in range(25)]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a\nA\na\n"), (None, "first of all\n" + pool[0])]
    for i in range(10, n):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            lines.append(" ".join(words) if rng.random() < 0.6 else " ".join(rng.choices(vocab, k=20)))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("task_tokens", [1 << 22, 300])
def test_matches_brute_force(make_docs, monkeypatch, task_tokens):
    monkeypatch.setattr(line_dedup, "TASK_TOKENS", task_tokens)
    rows = rows_of(task_tokens, 70)
    assert got(line_dedup.dedup_lines(make_docs(rows).repartition(3))) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(line_dedup.dedup_lines(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_repeated_rows_and_empty_table(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).collect() == []
    rows = [(1, "x y z\nx y z"), (1, "x y z\nx y z"), (2, "x y z")]
    out = line_dedup.dedup_lines(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, "x y z"), (1, "x y z"), (2, "")]


@pytest.mark.parametrize("task_tokens", [1 << 22, 60])
def test_rows_that_repeat_an_id_are_told_apart(make_docs, monkeypatch, task_tokens):
    monkeypatch.setattr(line_dedup, "TASK_TOKENS", task_tokens)
    rows = [(0, "x y z w v u"), (1, "x y z w v u"), (1, "totally different line of words here")]
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    pool = [" ".join(rng.choices(vocab, k=rng.choice([3, 12, 25]))) for _ in range(15)]
    for i in range(60):
        text = "\n".join(rng.choice(pool) if rng.random() < 0.6 else " ".join(rng.choices(vocab, k=9)) for _ in range(rng.randint(0, 4)))
        rows += [(rng.choice([None, 2, 3, i]), text)] * rng.choice([1, 1, 2])
    rows += [(None, None), (2, None), (2, ""), (3, " \n\t")]
    df = make_docs(rows).repartition(4)
    for c in ("id", "dig", "line", "node", "island", "removed", "gone"):
        df = df.withColumn(c, F.lit("clash"))
    out = line_dedup.dedup_lines(df).collect()
    assert Counter((r["doc_id"], r["text"], r["n_lines"], tuple(r["removed_lines"])) for r in out) == brute_rows(rows)


def test_very_long_text(make_docs):
    line = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, line + "\nshort line of six words here\n" + "x " * 50_000), (2, "\n".join(["short line of six words here"] * 2000))]
    out = line_dedup.dedup_lines(make_docs(rows)).collect()
    assert Counter((r["doc_id"], r["text"], r["n_lines"], tuple(r["removed_lines"])) for r in out) == brute_rows(rows)


def test_tables_between_the_steps_are_removed(spark, make_docs):
    from unilake.session import list_dir, work_root
    before = {n for n, _ in list_dir(spark, work_root(spark))}
    line_dedup.dedup_lines(make_docs(rows_of(2, 40))).collect()
    left = [n for n, _ in list_dir(spark, work_root(spark)) if n.startswith("llm-") and n not in before]
    assert len(left) <= 2   # what the result itself is read from


def test_later_matches_random():
    rng = random.Random(6)
    sets = []
    for _ in range(150):
        s = set(rng.choice(sets)) if sets and rng.random() < 0.7 else set(rng.sample(range(400), rng.randint(1, 40)))
        for _ in range(rng.randint(0, 4)):
            s.symmetric_difference_update({rng.randrange(400)})
        sets.append(s or {1})
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    want = [i for i, s in enumerate(sets) if any(100 * len(s & t) >= 75 * len(s | t) for t in sets[:i])]
    assert line_dedup.later_matches(arrays, [False] * len(sets)) == want


def test_only_lines_that_may_match_are_moved(make_docs, monkeypatch):
    other = "\n".join(" ".join(f"o{k}x{i}" for i in range(40)) for k in range(50))
    rows = [(i, f"{other}\nline {i} of six words here\n{other}") for i in range(20)]
    docs = make_docs(rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("dig"), "text")
    ranks = np.zeros(1 << 20, dtype=np.uint16)
    members = line_dedup._line_sets(docs, ranks, 0).where("line = 50").select("id", "dig", "line", "node").localCheckpoint()
    moved, join = [], type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda df, *a, **k: moved.append(df) or join(df, *a, **k))
    sets = line_dedup._token_sets(docs, members, ranks, 0).collect()
    assert sorted((r["node"], len(r["tokens"])) for r in sets) == sorted((r["node"], 16) for r in members.collect())
    assert sum(len(r["text"]) for df in moved[:1] for r in df.collect()) < 2 * sum(len(t) for _, t in rows) / 100


def test_lines_that_share_a_run_by_chance_stay_apart(make_docs):
    rng = random.Random(8)
    lines = [[f"l{i}w{k}" for k in range(60)] for i in range(150)]
    for i in range(149):  # a run of five words in this line and the next
        lines[i + 1][40:45] = lines[i][10:15] = rng.choices("abcdefghijklmnop", k=5)
    lines.append(lines[70][:57] + ["x", "y", "z"])
    rows = [(k, "\n".join(" ".join(w) for w in lines[k::10])) for k in range(10)]
    flat = np.zeros(1 << setkit.SKETCH_BITS, np.uint16)  # as loads are in a large corpus: all alike
    df = make_docs(rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("dig"), "text").repartition(3)
    own = line_dedup._line_sets(df, flat, 0).localCheckpoint()
    node = {(r["id"], r["line"]): r["node"] for r in own.collect()}
    assert together(setkit.islands(line_dedup._entries(own, 16))) == [{node[0, 7], node[0, 15]}]
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["removed_lines"])
            for r in line_dedup.dedup_lines(make_docs(rows)).collect()} == brute(rows)
