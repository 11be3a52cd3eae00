"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Vectors of one label are compared by cosine; pairs at ``LEAST`` or above link.

1. A label's vectors are dealt to shards of bounded size by a hash of the id,
   so a hot label is many shards.  Each shard becomes a graph in one task.
2. Every shard is queried with every vector of its label, in blocks of one
   shard's vectors.  A beam search finds neighbours; it starts at the query's own
   node where the graph has one.  Found neighbours stand for the linked group of
   their shard (built from the shard's own searches, which also answer its own
   block), and the cosine with every member of such a group is verified in double
   precision, so links are counted exactly where the search reached the group.
   A query whose beam is linked to its last node may have more: it is compared
   with the whole shard.
3. Audits: vectors of each block, in a seeded order, are compared with the whole
   shard until ``LINKED`` of those that beams answered have a link, or none is
   left.  While the beams miss more than ``LEAST_RECALL`` allows of a vector's
   links or linked groups (means over the vectors with a link, so a large group
   doesn't outweigh small ones), beams are doubled and all queries of the block
   run again; past ``WIDEST`` every query is compared with the whole shard.
4. What the beams missed: matrix products of the shard with its queries, in
   single precision with a margin above its error, point out linked rows outside
   the groups a search reached.  They are verified in double precision and
   added, so every link is counted.
5. Each search reports counts and, per linked group, one edge (for a vector's own
   group: to the group's first row): links are never listed pair by pair.  Edges
   are united into components.

Cases: a null or zero vector, one with null or non-finite components, or a null
label links with nothing (its own component); vectors of different lengths do
not link; equal vectors link; rows that repeat a vec_id count as separate
vectors but share its component; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm.common import components, cut

LEAST = 0.98
#: Vectors of a shard, about.
SHARD = 8192
#: Links of a node per level (twice on the ground), beam while building.
M, BUILD_BEAM = 8, 32
#: First and last beam of a query (a wider one costs more than the whole shard).
BEAM, WIDEST = 16, 64
#: Vectors drawn at a time for a block's audit; audited vectors with a link that
#: are enough; share of their links and linked groups that the beams must find.
AUDIT, LINKED, LEAST_RECALL = 64, 256, 0.995
#: Queries of one matrix product with a shard.
EXACT = 256


class Graph:
    """HNSW graph over unit vectors (rows)."""

    def __init__(self, x: np.ndarray, state: tuple | None = None):
        self.x = x.astype(np.float32)
        #: The last node of each distinct vector.
        self.at = {row.tobytes(): i for i, row in enumerate(self.x)}
        n = len(x)
        if state is not None:
            self.near, self.entry, self.top = state
            return
        levels = (-np.log(np.random.default_rng(7).uniform(1e-12, 1, n)) / np.log(M)).astype(int)
        self.near: list[dict[int, np.ndarray]] = [{} for _ in range(levels.max() + 1)]
        self.entry, self.top = 0, levels[0]
        for level in range(levels[0] + 1):
            self.near[level][0] = np.zeros(0, np.int64)
        for i in range(1, n):
            self._insert(i, int(levels[i]))

    def _insert(self, i: int, level: int):
        at = [self.entry]
        for k in range(self.top, level, -1):
            at = [self.search(self.x[i], at, 1, k)[1][0]]
        for k in range(min(level, self.top), -1, -1):
            sims, found = self.search(self.x[i], at, BUILD_BEAM, k)
            chosen = self._spread(sims, found, M)
            self.near[k][i] = chosen
            most = 2 * M if k == 0 else M
            for j in chosen.tolist():
                own = np.append(self.near[k][j], i)
                if len(own) > most:
                    s = self.x[own] @ self.x[j]
                    order = np.argsort(-s, kind="stable")
                    own = self._spread(s[order], own[order], most)
                self.near[k][j] = own
            at = found.tolist()
        for k in range(self.top + 1, level + 1):
            self.near[k][i] = np.zeros(0, np.int64)
        if level > self.top:
            self.entry, self.top = i, level

    def _spread(self, sims: np.ndarray, found: np.ndarray, most: int) -> np.ndarray:
        """Neighbours that are closer to the node than to each other, so that
        groups stay connected; filled up with the nearest others."""
        if len(found) <= most:
            return found
        between = self.x[found] @ self.x[found].T
        open_ = np.ones(len(found), dtype=bool)
        chosen = []
        for k in range(len(found)):
            if open_[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                open_ &= between[k] <= sims
        rest = [k for k in range(len(found)) if k not in set(chosen)]
        return found[(chosen + rest)[:most]]

    def search(self, q: np.ndarray, entries, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes found, nearest first: (similarities, nodes)."""
        near = self.near[level]
        seen = set(entries)
        sims = self.x[entries] @ q
        best = [(float(s), e) for s, e in zip(sims, entries, strict=True)]  # worst first
        heapq.heapify(best)
        while len(best) > beam:
            heapq.heappop(best)
        todo = [(-s, e) for s, e in best]
        heapq.heapify(todo)
        while todo:
            s, node = heapq.heappop(todo)
            if len(best) == beam and -s < best[0][0]:
                break
            fresh = [j for j in near[node].tolist() if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for v, j in zip((self.x[fresh] @ q).tolist(), fresh, strict=True):
                if len(best) < beam:
                    heapq.heappush(best, (v, j))
                    heapq.heappush(todo, (-v, j))
                elif v > best[0][0]:
                    heapq.heapreplace(best, (v, j))
                    heapq.heappush(todo, (-v, j))
        best.sort(key=lambda t: (-t[0], t[1]))
        return np.array([b[0] for b in best], dtype=np.float32), np.array([b[1] for b in best])

    def nearest(self, q: np.ndarray, beam: int) -> np.ndarray:
        """Nodes nearest to ``q``; the search for a node's own vector starts there."""
        own = self.at.get(q.tobytes())
        if own is not None:
            return self.search(q, [own], beam, 0)[1]
        at = [self.entry]
        for k in range(self.top, 0, -1):
            at = [int(self.search(q, at, 1, k)[1][0])]
        return self.search(q, at, beam, 0)[1]


def linked(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``q`` (both of length 1, double) reaches ``LEAST``."""
    return x @ q >= LEAST


def near_rows(x: np.ndarray, graph: Graph, q: np.ndarray, beam: int) -> tuple[np.ndarray, bool]:
    """Rows that a beam finds next to ``q``, and whether they are all of the
    shard's linked rows: a beam that links to its last node may have left out
    others, so the query is compared with every row, as past ``WIDEST``."""
    if beam < len(x) and beam <= max(WIDEST, BEAM):
        found = graph.nearest(q.astype(np.float32), beam)
        s = x[found] @ q
        if s[-1] < LEAST - 1e-6:
            return found[s >= LEAST - 1e-6], False
    return np.flatnonzero(linked(x, q)), True


def answers(x: np.ndarray, graph: Graph, q: np.ndarray, beam: int) -> list[tuple[np.ndarray, bool]]:
    """``near_rows`` of every row of ``q``; rows out of the whole shard as packed
    bits, since numbers would fill the memory where groups are large."""
    out = []
    for i in range(len(q)):
        near, whole = near_rows(x, graph, q[i], beam)
        if whole:
            bits = np.zeros(len(x), dtype=bool)
            bits[near] = True
            near = np.packbits(bits)
        out.append((near, whole))
    return out


def rows_in(answer: tuple[np.ndarray, bool], n: int) -> np.ndarray:
    near, whole = answer
    return np.flatnonzero(np.unpackbits(near, count=n)) if whole else near


def groups_of(x: np.ndarray, own: list) -> np.ndarray:
    """A group number per row: rows that the shard's own searches link; ``own``:
    their answers."""
    root = np.arange(len(x))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        found = rows_in(own[i], len(x))
        if not own[i][1]:
            found = found[linked(x[found], x[i])]
        for j in np.unique(root[found]).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(len(x))])


def query(x, group, members, q, answer, skip=-1):
    """Number of the shard's rows linked to ``q`` in the groups that its search
    (``answer``) reached, one linked row of each such group, and whether the whole
    shard was compared.  ``skip``: the query's own row."""
    near = rows_in(answer, len(x))
    if answer[1]:
        hit = near[near != skip]
        return len(hit), hit[np.unique(group[hit], return_index=True)[1]].tolist(), True
    count, rows = 0, []
    for g in dict.fromkeys(group[near].tolist()):
        own = members[g]
        hit = own[linked(x[own], q)]
        hit = hit[hit != skip]
        if len(hit):
            count += len(hit)
            rows.append(int(hit[0]))
    return count, rows, False


def passes(x: np.ndarray, q: np.ndarray, same: bool, group: np.ndarray, got: list) -> bool:
    """The beams' answers ``got`` hold enough of the links and linked groups of
    the audited rows.  Without any link among them all rows have been compared."""
    rows = np.array([i for i in np.random.default_rng(7).permutation(len(q)).tolist() if not got[i][2]], dtype=int)
    recalls: list[tuple[float, float]] = []
    for at in range(0, len(rows), AUDIT):
        drawn = rows[at:at + AUDIT]
        want = linked(x, q[drawn].T)
        if same:
            want[drawn, np.arange(len(drawn))] = False
        for k in np.flatnonzero(want.any(axis=0)).tolist():
            own = group[want[:, k]]
            links, reached, _ = got[drawn[k]]
            recalls.append((min(links / len(own), 1.0), min(len(reached) / len(np.unique(own)), 1.0)))
        if len(recalls) >= LINKED:
            break
    return not recalls or bool(np.mean(recalls, axis=0).min() >= LEAST_RECALL)


def missed(x: np.ndarray, q: np.ndarray, same: bool, group: np.ndarray, got: list) -> list:
    """``got`` with the links that lie outside the groups that the beams reached."""
    x32, (number, of) = x.astype(np.float32), np.unique(group, return_inverse=True)
    least = LEAST - (x.shape[1] + 4) * 2.0 ** -22   # beyond the products' rounding errors
    out = list(got)
    for at in range(0, len(q), EXACT):
        part = q[at:at + EXACT]
        known = np.zeros((len(number), len(part)), dtype=bool)
        for k, (_, rows, whole) in enumerate(got[at:at + EXACT]):
            known[slice(None) if whole else of[rows], k] = True
        near = x32 @ part.astype(np.float32).T >= least
        near &= ~known[of]
        if same:
            near[np.arange(at, at + len(part)), np.arange(len(part))] = False
        for k in np.flatnonzero(near.any(axis=0)).tolist():
            hit = np.flatnonzero(near[:, k])
            hit = hit[linked(x[hit], part[k])]
            count, rows, whole = got[at + k]
            out[at + k] = (count + len(hit), rows + hit[np.unique(group[hit], return_index=True)[1]].tolist(), whole)
    return out


def search_block(graph: Graph, x: np.ndarray, q: np.ndarray, same: bool) -> list[tuple[int, list[int]]]:
    """(links, one linked row per group) of every row of ``q`` in shard ``x``;
    ``same``: the queries are the shard's own rows, which don't link to themselves;
    of their own group they name the first row, whose links hold the group together."""
    beam = BEAM
    while True:
        own = answers(x, graph, x, beam)
        group = groups_of(x, own)
        members = _members(group)
        asked = own if same else answers(x, graph, q, beam)
        got = [query(x, group, members, q[i], asked[i], i if same else -1) for i in range(len(q))]
        if passes(x, q, same, group, got):
            break
        beam *= 2
    got = missed(x, q, same, group, got)
    if not same:
        return [g[:2] for g in got]
    return [(n, [r for r in rows if group[r] != group[i]] + ([int(group[i])] if group[i] != i else []))
            for i, (n, rows, _) in enumerate(got)]


def _members(group: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(group, kind="stable")
    keys, at = np.unique(group[order], return_index=True)
    return dict(zip(keys.tolist(), np.split(order, at[1:]), strict=True))


def near_vectors(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    v = table.select(table["vec_id"], table["embedding"].cast("array<double>").alias("embedding"),
                     table["label"].cast("string").alias("label"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("label").isNotNull() & F.coalesce(finite & (norm > 0) & (norm < F.lit(float("inf"))), F.lit(False))
    v = cut(v.withColumn("row", F.monotonically_increasing_id()).withColumn("good", good))
    # vectors of different lengths can't be compared: length is part of the label
    own = v.where("good").withColumn("label", F.concat_ws(":", F.size("embedding"), "label"))
    sizes = own.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD)).alias("shards"))
    own = cut(own.join(sizes, "label").select(
        "row", "vec_id", "embedding", "label", "shards",
        F.pmod(F.xxhash64("vec_id", "row"), F.col("shards")).alias("shard")))

    def build(pdf):
        pdf = pdf.sort_values("row", kind="stable")
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        g = Graph(x)
        return pd.DataFrame({"label": pdf["label"][:1], "shard": pdf["shard"][:1], "size": [len(x)],
                             "rows": [pdf["row"].to_numpy().tobytes()], "x": [x.tobytes()],
                             "graph": [pickle.dumps((g.near, g.entry, g.top))]})

    shards = cut(own.groupBy("label", "shard").applyInPandas(
        build, "label string, shard long, size long, rows binary, x binary, graph binary"))
    blocks = shards.select("label", F.col("shard").alias("asking"), F.col("size").alias("q_size"),
                           F.col("rows").alias("q_rows"), F.col("x").alias("q"))

    def run(batches):
        for batch in batches:
            for t in batch.to_pylist():
                x = np.frombuffer(t["x"], dtype=np.float64).reshape(t["size"], -1)
                q = np.frombuffer(t["q"], dtype=np.float64).reshape(t["q_size"], -1)
                rows, q_rows = (np.frombuffer(t[r], dtype=np.int64) for r in ("rows", "q_rows"))
                got = search_block(Graph(x, pickle.loads(t["graph"])), x, q, t["shard"] == t["asking"])
                keep = [i for i, (n, to) in enumerate(got) if n or to]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_rows[keep]), pa.array([got[i][0] for i in keep], pa.int64()),
                     pa.array([rows[got[i][1]].tolist() for i in keep], pa.list_(pa.int64()))],
                    ["row", "links", "edges"])

    # a task's work is a pair of blocks, whatever its bytes: deal the pairs
    n_tasks = (sizes.agg(F.sum(F.col("shards") * F.col("shards"))).first()[0] or 0) * 4
    tasks = shards.join(blocks, "label").repartition(
        int(min(max(n_tasks, 8), 100_000)), F.xxhash64("label", "shard", "asking"))
    found = cut(tasks.drop("label").mapInArrow(run, "row long, links long, edges array<long>"))
    links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    ids = v.select("row", "vec_id")
    pairs = found.select("row", F.explode("edges").alias("to")).join(ids, "row").join(
        ids.toDF("to", "other"), "to")
    comp = components(pairs, "vec_id", "other")
    component = F.coalesce("component", "vec_id")
    return ids.join(links, "row", "left").join(comp, ids["vec_id"] == comp["node"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"))
