"""Exact routing of similar sets: which sets could reach the threshold at all.

Items (documents or lines) are sets of 64-bit token hashes.  Two sets with
Jaccard similarity of at least 3/4 share k tokens among the first
n - ceil(3n/4) + k of each, in any order of tokens that is the same for all
sets, and their sizes differ by a factor of 4/3 at most.  k is ``shared`` of the
smaller set's size.  The order used is by corpus load: tokens are hashed into
2**SKETCH_BITS groups, the group totals are counted over the whole corpus, and
tokens of light groups come first.  Very common passages therefore rarely route
anything.

``islands`` groups the sets that are connected by such shared tokens and
fitting sizes.  Every link lies inside one island.  Two sets are connected once
they share all k tokens: in a large corpus nearly every set shares one with some
other by chance, and one alone would connect nearly all of them.  A token with
more than ``FEW`` holders of fitting sizes is not counted by pairs: it connects
its holders at once, and costs each task one entry per run of sizes, never a
list of all holders.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unilake.llm.common import components, cut
from unilake.llm.textkit import U, mix64, set_digests, sorted_sets

#: log2 of the number of hash groups whose corpus totals order the tokens.
SKETCH_BITS = 20
_PART = 1 << 12
#: Keys combined at a time inside a task.
_COMBINE = 1 << 21
#: Holders of fitting sizes, after each holder of a token, that are counted by pairs.
FEW = 16
#: Most tokens that a pair must share, and what all of them weigh together (a multiple of 1 .. MOST).
MOST, FULL = 8, 840
#: Bytes of text hashed at a time.
CHUNK = 1 << 19


def group_totals(df: DataFrame, hashes) -> np.ndarray:
    """Tokens per hash group over all rows (2**SKETCH_BITS totals, whatever
    the input's size).  ``hashes(batch)`` gives one array of token hashes per
    chunk of a batch."""
    parts = (1 << SKETCH_BITS) // _PART

    def count(batches):
        total, held = np.zeros(1 << SKETCH_BITS, dtype=np.int64), []

        def add_held():
            total[:] += np.bincount(np.concatenate([hash_group(h) for h in held]), minlength=len(total))
            held.clear()

        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                if sum(map(len, held)) >= len(total):
                    add_held()
        if held:
            add_held()
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(parts), pa.int32()),
                 pa.array([x.astype(np.uint32).tobytes() for x in total.reshape(parts, _PART)], pa.binary())],
                ["part", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                own = total.setdefault(part, np.zeros(_PART, dtype=np.int64))
                own += np.frombuffer(counts.as_buffer(), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            ["part", "counts"])

    rows = df.mapInArrow(count, "part int, counts binary").repartition("part") \
        .mapInArrow(add, "part int, counts binary").collect()
    out = np.zeros((parts, _PART), dtype=np.int64)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], dtype=np.int64)
    return out.reshape(-1)


def load_ranks(totals: np.ndarray) -> np.ndarray:
    """Rank of each hash group by load, in 32nds of a doubling."""
    return np.floor(32 * np.log2(np.maximum(totals, 1))).astype(np.uint16)


def hash_group(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - SKETCH_BITS)).astype(np.int64)


def shared(n: np.ndarray) -> np.ndarray:
    """Routing tokens that a set of ``n`` tokens shares with each similar one of its size or more."""
    return 1 + np.minimum(n // 16, MOST - 1)


def routed_sets(h: np.ndarray, owner: np.ndarray, n_owners: int, ranks: np.ndarray,
                seed: int) -> dict[str, np.ndarray]:
    """Per owner: set size, digest, second digest, and its routing keys."""
    flat, off = sorted_sets(h, owner, n_owners, ranks[hash_group(h)])
    n = np.diff(off)
    prefix = np.where(n > 0, n - (3 * n + 3) // 4 + shared(n), 0)
    pos = np.arange(len(flat)) - np.repeat(off[:-1], n)
    return {"n": n, "node": set_digests(flat, off, seed).view(np.int64),
            "check": set_digests(flat, off, seed + 1_000_003).view(np.int64),
            "keys": flat[pos < np.repeat(prefix, n)], "key_off": np.r_[0, np.cumsum(prefix)]}


def _key_order(key, node, n):
    """Order by key, size, node: the keys' first bits are sorted with their places
    as plain numbers, then whoever shares those bits is put in order."""
    at = max(len(key) - 1, 0).bit_length()
    packed = (key & ~U((1 << at) - 1)) | np.arange(len(key), dtype=U)
    packed.sort()
    order = (packed & U((1 << at) - 1)).view(np.int64)
    packed >>= U(at)
    same = packed[1:] == packed[:-1]
    tied = np.zeros(len(key), dtype=bool)
    tied[1:] |= same
    tied[:-1] |= same
    sub = order[tied]
    order[tied] = sub[np.lexsort((node[sub], n[sub], key[sub]))]
    return order


def _distinct_pairs(pairs):
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    keep = np.ones(len(pairs), dtype=bool)
    keep[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    return pairs[keep]


def _crowded(first, low):
    """By row, whether its key has a holder with more than ``FEW`` later ones of
    fitting sizes.  Rows are in order of key and size; ``first`` marks each key's first."""
    group, far = np.cumsum(first) - 1, FEW + 1
    at = np.flatnonzero(group[far:] == group[:-far])
    out = np.zeros(len(low), dtype=bool)
    out[group[at[4 * low[at] >= 3 * low[at + far]]]] = True
    return out[group]


def _firsts(key):
    return np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, dtype=bool)


def combine(key, node, n):
    """Merge entries of one task.  A crowded key gives links between its
    sizes-next holders and one entry (key, a holder, least size, largest size) per
    run, any other an entry for each holder.  The last but one array marks the
    entries of crowded keys."""
    order = _key_order(key, node, n)
    key, node, n = key[order], node[order], n[order]
    new = _firsts(key)
    new[1:] |= node[1:] != node[:-1]
    key, node, n = key[new], node[new], n[new]
    first = _firsts(key)
    crowded = _crowded(first, n)
    joined = ~first[1:] & crowded[1:] & (4 * n[:-1] >= 3 * n[1:])
    pairs = np.stack([node[:-1][joined], node[1:][joined]], axis=1)
    head = np.flatnonzero(np.r_[True, ~joined]) if len(key) else np.zeros(0, np.int64)
    last = np.r_[head[1:], len(key)] - 1
    return key[head], node[head], n[head], n[last] if len(key) else n, crowded[head], pairs


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def packed_entries(stream, n_buckets: int):
    """Arrow rows (bucket, keys, nodes, low, spread, links) of a task's entries.

    ``stream`` gives (keys, nodes, sizes) arrays.  Keys are cut to 48 bits
    besides the bucket: a false match only adds work, verification decides.
    The spread of a crowded key's entry is its largest size less the least, plus 1.
    """
    held, size = [], 0

    def flush():
        key, node, n = (np.concatenate(x) for x in zip(*held, strict=True))
        key, node, low, high, crowded, pairs = combine(key, node, n)
        spread = high - low + crowded
        pairs = _distinct_pairs(pairs)
        bucket = (key % U(n_buckets)).astype(np.uint16 if n_buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        key, node, low, spread, bucket = (x[order] for x in (key, node, low, spread, bucket))
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        short = key.view(np.uint8).reshape(-1, 8)[:, 2:]
        share = np.linspace(0, len(pairs), n_buckets + 1).astype(np.int64)
        cols = [[], [], [], [], [], []]
        for b in range(n_buckets):
            i, j = cuts[b], cuts[b + 1]
            p, q = share[b], share[b + 1]
            if i < j or p < q:
                for c, x in zip(cols, (b, _pack(short[i:j]), _pack(node[i:j]),
                                       _pack(low[i:j].astype(np.uint32)),
                                       _pack(spread[i:j].astype(np.uint32)),
                                       _pack(pairs[p:q])), strict=True):
                    c.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
            ["bucket", "keys", "nodes", "low", "spread", "links"])

    for key, node, n in stream:
        held.append((key, node, n))
        size += len(key)
        if size >= _COMBINE:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


ENTRY_SCHEMA = "bucket int, keys binary, nodes binary, low binary, spread binary, links binary"


def _bucket_links(pdf):
    """(a, b, weight) between the entries of one bucket: ``FULL`` for neighbours
    under a crowded key, by key and running size, and a share of it for each
    other key that two nodes of fitting sizes share."""
    def cat(col, kind):
        return np.frombuffer(b"".join(pdf[col]), dtype=kind)

    short = cat("keys", np.uint8).reshape(-1, 6)
    key = np.zeros((len(short), 8), dtype=np.uint8)
    key[:, 2:] = short
    key = key.view(np.uint64).reshape(-1)
    node, low = cat("nodes", np.int64), cat("low", np.uint32).astype(np.int64)
    spread = cat("spread", np.uint32).astype(np.int64)
    links = [cat("links", np.int64).reshape(-1, 2)]
    weights = [np.full(len(links[0]), FULL)]
    order = _key_order(key, node, low)
    key, node, low, spread = key[order], node[order], low[order], spread[order]
    new = _firsts(key)
    new[1:] |= (node[1:] != node[:-1]) | (spread[1:] > 0) | (spread[:-1] > 0)
    key, node, low, spread = key[new], node[new], low[new], spread[new]
    if len(key):
        first = _firsts(key)
        group = np.cumsum(first)
        crowded = _crowded(first, low) | (np.bincount(group[spread > 0], minlength=group[-1] + 1) > 0)[group]
        high = low + np.maximum(spread - 1, 0)
        reach = np.maximum.accumulate(group * (1 << 40) + high) - group * (1 << 40)
        link = ~first[1:] & crowded[1:] & (4 * reach[:-1] >= 3 * low[1:]) & (node[1:] != node[:-1])
        links.append(np.stack([node[:-1][link], node[1:][link]], axis=1))
        weights.append(np.full(len(links[-1]), FULL))
        at = np.flatnonzero(~crowded[1:] & ~first[1:])
        for d in range(1, FEW + 1):  # whose size doesn't fit the next one's fits none behind
            at = at[at + d < len(key)]
            at = at[(group[at + d] == group[at]) & (4 * low[at] >= 3 * low[at + d])]
            links.append(np.stack([node[at], node[at + d]], axis=1))
            weights.append(FULL // shared(low[at]))
    pairs, weight = np.sort(np.concatenate(links), axis=1), np.concatenate(weights)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs, weight = pairs[order], weight[order]
    head = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)]) if len(pairs) else np.zeros(0, np.int64)
    weight = np.minimum(np.add.reduceat(weight, head), FULL) if len(pairs) else weight
    return pd.DataFrame({"a": pairs[head, 0], "b": pairs[head, 1], "weight": weight.astype(np.int32)})


def islands(entries: DataFrame) -> DataFrame:
    """(node, component) of the sets that share their routing keys at fitting sizes."""
    links = entries.groupBy("bucket").applyInPandas(_bucket_links, "a long, b long, weight int")
    return components(links.groupBy("a", "b").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= FULL))


def bitmap(df: DataFrame, column: str | Column, bits: int = 1 << 26) -> np.ndarray:
    """One bit per hash value of ``column``: a filter of fixed size (8 MB).

    It lets through every listed value and some others; an exact join follows.
    A Column gives the slots themselves, 1 .. bits.
    """
    slot = hash_slot(F.col(column), bits) if isinstance(column, str) else column
    rows = df.select(slot.alias("h")) \
        .groupBy(F.expr("bitmap_bucket_number(h)").alias("k")) \
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("m")).collect()
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:  # bucket k holds the slots 32768 * (k - 1) .. 32768 * k - 1
        m = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
        at = (int(r["k"]) - 1) * 4096
        out[at:at + len(m)] |= m
    return out


def hash_slot(col, bits: int):
    """1 .. bits, as the bitmap functions number their slots."""
    return F.pmod(F.xxhash64(col), F.lit(bits)) + F.lit(1)


def passes(mask: np.ndarray, slots: np.ndarray) -> np.ndarray:
    at = slots - 1
    return (mask[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
