"""N-gram Jaccard join: near-duplicate documents by a count-vector R-tree.

A document's set holds its distinct runs of five words; two documents link at
a Jaccard similarity of 3/4.  Steps:

1. hash every shingle into groups and total the groups over the corpus;
2. hash each document's set; equal sets share one node;
3. route: nodes that share as many tokens of light groups as similar sets must,
   at sizes within 4/3 of each other, form islands (exact: a link never leaves
   its island);
4. each island is a count-vector R-tree: bound overlaps by summed coordinate
   minima, verify what survives, skip pairs already joined by other links.
   Islands are packed into tasks of bounded size.  An island beyond that is
   split into blocks by set size and hash; pairs of blocks are joined on the
   points alone, and only the sets of surviving pairs are moved;
5. union the links into components.

A row is known by its doc_id and a digest of its text, so rows without doc_id and
rows that repeat one are told apart.

Cases: a null or empty text, or one without words, has an empty set and links
with nothing; a text of fewer than five words is one shingle; equal rows have
equal sets and link; rows that repeat a doc_id with other words share its
component; a row without doc_id links like any other, and its component is the
smallest doc_id reached (null where none of the reached rows has one); ties do
not exist (the test is exact in integers); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm import setkit
from unilake.llm.common import bound_batches, components, cut, documents, drop, settled, sift
from unilake.llm.rtree import count_points, group_number, linked_roots, overlaps, surviving_pairs
from unilake.llm.textkit import (LOWER, SPACE, chunks, shingle_hashes, sorted_sets, span_hashes,
                                 string_bytes, word_spans)

WIDTH = 5
#: Tokens in one task's trees; a larger island is split into blocks.
TASK_TOKENS = 1 << 22
#: Pairs that one copy of a set is verified against.
PAIRS_PER_TASK = 512
#: Sizes of one band differ by less than this factor.
BAND = 1.15
#: Bands that sizes within 4/3 of each other can lie apart.
REACH = 3
_NULL_ID = -(1 << 63)


def _shingles(text: pa.Array):
    """(first row, rows, hashes, owners) for chunks of a text column."""
    data, off = string_bytes(text)
    for i, j in chunks(np.diff(off), setkit.CHUNK):
        part = LOWER[data[off[i]:off[j]]]
        at = off[i:j + 1] - off[i]
        s, e = word_spans(part, at, ~SPACE)
        owner = np.searchsorted(at, s, side="right") - 1
        h, o = shingle_hashes(span_hashes(part, s, e), owner, WIDTH)
        yield i, j - i, h, o


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the row's key: id (never null) and dig, a digest of the text."""
    return documents(docs, "doc_id", "text").select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("dig"))


def document_sets(docs: DataFrame, ranks: np.ndarray, seed: int) -> DataFrame:
    """doc_id, id, dig, n (set size), node and check (digests of the set)."""
    def run(batches):
        for batch in batches:
            own = [batch.column(c) for c in ("doc_id", "id", "dig")]
            for i, m, h, o in _shingles(batch.column("text")):
                s = setkit.routed_sets(h, o, m, ranks, seed)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, m) for c in own], pa.array(s["n"]), pa.array(s["node"]), pa.array(s["check"])],
                    ["doc_id", "id", "dig", "n", "node", "check"])

    return docs.mapInArrow(run, "doc_id long, id long, dig long, n long, node long, check long")


def _entries(docs: DataFrame, ranks: np.ndarray, seed: int, n_buckets: int) -> DataFrame:
    """Routing entries, hashed from the texts again: keys are never stored."""
    def run(batches):
        def stream():
            for batch in batches:
                for _, m, h, o in _shingles(batch.column("text")):
                    s = setkit.routed_sets(h, o, m, ranks, seed)
                    lens = np.diff(s["key_off"])
                    yield s["keys"], np.repeat(s["node"], lens), np.repeat(s["n"], lens)

        yield from setkit.packed_entries(stream(), n_buckets)

    return docs.select("text").mapInArrow(run, setkit.ENTRY_SCHEMA)


def _texts(docs: DataFrame, keep: np.ndarray, members: DataFrame) -> DataFrame:
    """The members with their documents' texts.  Only those texts are moved,
    after a filter of fixed size."""
    def pick(batches):
        for batch in batches:
            ok = setkit.passes(keep, batch.column("slot").to_numpy())
            yield batch.select(["id", "dig", "text"]).filter(pa.array(ok))

    slot = setkit.hash_slot(F.col("dig"), len(keep) * 8).alias("slot")
    some = docs.select("id", "dig", "text", slot).mapInArrow(pick, "id long, dig long, text string")
    return some.join(members, ["id", "dig"])


def _token_sets(docs: DataFrame, keep: np.ndarray, members: DataFrame) -> DataFrame:
    """The members with their sorted tokens as packed bytes."""
    def run(batches):
        for batch in batches:
            rest = [batch.column(c) for c in carried]
            for i, m, h, o in _shingles(batch.column("text")):
                flat, off = sorted_sets(h, o, m)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, m) for c in rest],
                     pa.array([flat[off[k]:off[k + 1]].tobytes() for k in range(m)], pa.binary())],
                    [*carried, "tokens"])

    joined = _texts(docs, keep, members).drop("id", "dig")
    carried = [c for c in joined.columns if c != "text"]
    kinds = ", ".join(f"{c} {t}" for c, t in joined.dtypes if c != "text")
    return joined.mapInArrow(run, f"{kinds}, tokens binary")


def _join_tasks(sets: DataFrame) -> DataFrame:
    """Verified links (a, b) between the nodes of each island of each task."""
    def run(pdf):
        out = []
        for _, g in pdf.groupby("island", sort=False):
            g = g.sort_values(["n", "node"], kind="stable")
            flat = np.frombuffer(b"".join(g["tokens"]), dtype=np.uint64)
            off = np.r_[0, np.cumsum(g["n"].to_numpy())]
            node = g["node"].to_numpy()
            out += [(node[i], node[j]) for i, j in linked_roots(flat, off, node)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return sets.groupBy("task").applyInPandas(run, "a long, b long")


def _points(docs: DataFrame, keep: np.ndarray, members: DataFrame) -> DataFrame:
    """The members with their count points (about a byte a token) as packed bytes."""
    def run(batches):
        for batch in batches:
            rest = [batch.column(c) for c in carried]
            for i, m, h, o in _shingles(batch.column("text")):
                flat, off = sorted_sets(h, o, m)
                points = [count_points(flat[off[k]:off[k + 1]], np.array([0, off[k + 1] - off[k]]),
                                       group_number(int(off[k + 1] - off[k])))
                          .astype(np.uint32).tobytes() for k in range(m)]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, m) for c in rest], pa.array(points, pa.binary())], [*carried, "point"])

    joined = _texts(docs, keep, members).drop("id", "dig")
    carried = [c for c in joined.columns if c != "text"]
    kinds = ", ".join(f"{c} {t}" for c, t in joined.dtypes if c != "text")
    return joined.mapInArrow(run, f"{kinds}, point binary")


def _block_candidates(points: DataFrame, pairs: DataFrame, forest: bool) -> DataFrame:
    """(a, b): node pairs that survive the bounds in pairs of blocks."""
    def run(pdf):
        pdf = pdf.sort_values(["n", "node"], kind="stable")
        rows = [np.frombuffer(x, dtype=np.uint32) for x in pdf["point"]]
        groups = min(len(r) for r in rows)  # a finer point folds onto a coarser one
        folded = np.stack([r.reshape(-1, groups).sum(axis=0, dtype=np.int32) for r in rows])
        folded = folded.astype(np.int16 if folded.max() < 1 << 15 else np.int32)
        side, node = pdf["side"].to_numpy(), pdf["node"].to_numpy()
        got = surviving_pairs(pdf["n"].to_numpy(), folded, pdf["root"].to_numpy(),
                              side if side.min() != side.max() else None, forest)
        return pd.DataFrame([(node[i], node[j]) for i, j in got], columns=["a", "b"], dtype="int64")

    task = F.concat_ws(":", "island", "ba", "sa", "bb", "sb").alias("task")
    same = (F.col("ba") == F.col("bb")) & (F.col("sa") == F.col("sb"))
    left = pairs.select("island", F.col("ba").alias("band"), F.col("sa").alias("slice"), task,
                        F.lit(0).alias("side"))
    right = pairs.where(~same).select("island", F.col("bb").alias("band"), F.col("sb").alias("slice"),
                                      task, F.lit(1).alias("side"))
    return points.join(left.union(right), ["island", "band", "slice"]).groupBy("task") \
        .applyInPandas(run, "a long, b long").distinct()


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold, decided on their tokens."""
    pairs = cut(pairs)
    ends = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
               .join(nodes.select("node", "id", "dig", "n"), "node"))
    sets = cut(_token_sets(docs, setkit.bitmap(ends, "dig"), ends))
    # a node in many pairs is sent to as many tasks as its pairs need
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAIRS_PER_TASK)).alias("parts"))
    to = cut(pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")))
    hubs = to.select("a", "part").distinct().join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", "part", F.col("a").alias("b"), "tokens")
    others = to.join(sets.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "tokens")

    def run(pdf):
        out = []
        for _, g in pdf.groupby(["a", "part"], sort=False):
            a = g["a"].iloc[0]
            own = np.frombuffer(g.loc[g["b"] == a, "tokens"].iloc[0], dtype=np.uint64)
            rest = g[g["b"] != a]
            tokens = [np.frombuffer(x, dtype=np.uint64) for x in rest["tokens"]]
            off = np.r_[0, np.cumsum([len(t) for t in tokens])]
            both = overlaps(own, np.concatenate(tokens), off, np.arange(len(tokens)))
            out += [(a, b) for b in rest["b"][7 * both >= 3 * (len(own) + np.diff(off))]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    # tasks of about as many tokens as an island's task
    total = to.join(nodes.select(F.col("node").alias("b"), "n"), "b").agg(F.sum("n")).first()[0] or 0
    bins = F.pmod(F.xxhash64("a", "part"), F.lit(max(16, int(total // (TASK_TOKENS // 4)) + 1))).alias("bin")
    return hubs.union(others).withColumn("bin", bins).groupBy("bin").applyInPandas(run, "a long, b long")


def link_islands(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links that connect each island's sets just as all its links would.

    ``docs``: as ``keyed`` gives them; ``nodes``: node, n, id and dig (of a row with
    that set), island.
    """
    nodes = cut(nodes)
    tokens = nodes.agg(F.sum("n")).first()[0] or 0
    bins = max(16, int(tokens // (TASK_TOKENS // 2)) + 1)
    sized = nodes.join(nodes.groupBy("island").agg(F.sum("n").alias("total")), "island")
    small = cut(sized.where(F.col("total") <= TASK_TOKENS).select(
        "id", "dig", "node", "n", "island", F.pmod(F.xxhash64("island"), F.lit(bins)).alias("task")))
    large = cut(sized.where(F.col("total") > TASK_TOKENS).drop("total"))
    links = cut(_join_tasks(_token_sets(docs, setkit.bitmap(small, "dig"), small)))
    if large.isEmpty():
        return links
    # blocks of about a task's tokens: by size band, then by hash
    large = large.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(BAND))))
    per = large.groupBy("island", "band").agg(F.sum("n").alias("tokens")).select(
        "island", "band", F.ceil(F.col("tokens") / F.lit(TASK_TOKENS)).alias("slices"))
    large = cut(large.join(per, ["island", "band"]).withColumn(
        "slice", F.pmod(F.xxhash64("node"), F.col("slices"))).drop("slices"))
    points = cut(_points(docs, setkit.bitmap(large, "dig"), large))
    blocks = cut(large.select("island", "band", "slice").distinct())
    pairs = cut(blocks.toDF("island", "ba", "sa").join(blocks.toDF("island", "bb", "sb"), "island").where(
        (F.col("bb") - F.col("ba")).between(0, REACH)
        & ((F.col("ba") < F.col("bb")) | (F.col("sa") <= F.col("sb")))))
    # first each block with itself and with the first block of its band and
    # the next; then the other pairs, unless all their rows are connected
    first = F.expr("(ba = bb and (sa = sb or sa = 0)) or (bb = ba + 1 and sa = 0 and sb = 0)")
    links = cut(links.union(_verified(docs, _block_candidates(
        points.withColumn("root", F.col("node")), pairs.where(first), True), large)))
    comp = components(links)
    points = points.join(comp, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component")
    span = cut(points.groupBy("island", "band", "slice").agg(F.min("root").alias("lo"), F.max("root").alias("hi")))
    rest = pairs.join(span.toDF("island", "ba", "sa", "la", "ha"), ["island", "ba", "sa"]).join(
        span.toDF("island", "bb", "sb", "lb", "hb"), ["island", "bb", "sb"]).where(
            "not (la = ha and lb = hb and la = lb)")
    return links.union(_verified(docs, _block_candidates(points, rest, False), large))


def grouped_rows(docs: DataFrame, by_id: bool = True) -> DataFrame:
    """doc_id, id, dig, n, node and component_id of every row, and ``group``: what
    the rows of one component share (null for rows without words).  ``by_id``:
    rows that repeat a doc_id belong together whatever their words."""
    docs = keyed(docs)
    bound_batches(docs.sparkSession, 1 << 22)

    def hashes(batch):
        return (h for _, _, h, _ in _shingles(batch.column("text")))

    ranks = setkit.load_ranks(setkit.group_totals(docs.select("text"), hashes))
    seed = 0
    while True:
        sets = cut(document_sets(docs, ranks, seed))
        nodes = sets.where("n > 0").groupBy("node").agg(
            F.min(F.struct("id", "dig")).alias("row"), F.min("doc_id").alias("least"), F.min("n").alias("n"),
            F.min("check").alias("c0"), F.max("check").alias("c1"), F.max("n").alias("n1"))
        nodes = cut(nodes)
        if nodes.where("c0 <> c1 or n <> n1").isEmpty():
            break
        drop(sets, nodes)
        seed += 1  # two sets had one digest: hash them anew
    tokens = nodes.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(256, int(tokens // 4_000_000) + 1)
    island = setkit.islands(_entries(docs, ranks, seed, n_buckets))
    island = island.withColumnRenamed("component", "island")
    links = link_islands(docs, nodes.select("node", "row.id", "row.dig", "n").join(island, "node"))
    edges = links.select("a", "b")
    held = sets.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    held = sets.join(held, "doc_id").where("n > 0 and node <> a").select("a", F.col("node").alias("b"))
    comp = components(edges.union(held) if by_id else edges)
    groups = nodes.select("node", "least").join(comp, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("group"))
    smallest = groups.groupBy("group").agg(F.min("least").alias("smallest"))
    groups = groups.join(smallest, "group").select("node", "group", "smallest")
    own = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    # rows without words match no node; keys of their own spread them
    key = F.when(F.col("n") > 0, F.col("node")).otherwise(F.monotonically_increasing_id())
    return sets.withColumn("node", key).join(groups, "node", "left").select(
        "doc_id", "id", "dig", "n", "node", F.when(F.col("n") > 0, F.col("group")).alias("group"), own.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    return grouped_rows(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _behind(docs: DataFrame) -> DataFrame:
    """(_gone_id, _gone_dig): the rows that stand behind another one of their component."""
    rows = cut(grouped_rows(docs, by_id=False))
    order = F.struct(F.col("doc_id").isNull(), F.col("id"), F.col("dig"))
    first = rows.where("group is not null").groupBy("group").agg(F.min(order).alias("first"))
    return rows.join(first, "group").where(order != F.col("first")).select(
        F.col("id").alias("_gone_id"), F.col("dig").alias("_gone_dig")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for those that stand behind another one of their
    component, with all their columns: the row with the smallest doc_id stays (one
    without doc_id only where none has one; of equals, that with the smallest
    digest).  Only words link here: rows that repeat a doc_id with other words all
    stay, and so do rows without words.  Texts are moved only of rows whose doc_id
    may be that of a row that goes."""
    gone = settled(lambda: _behind(docs))
    same = (F.coalesce(docs["doc_id"], F.lit(_NULL_ID)) == gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_dig"])
    gone_id = F.nullif(gone["_gone_id"], F.lit(_NULL_ID))
    clear, rest = sift(docs, "doc_id", gone.select("_gone_id").union(gone.select(gone_id)))
    return clear.union(rest.join(gone, same, "left_anti"))
