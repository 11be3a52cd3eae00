"""Shards of near-equal bytes: minimax contiguous partition (DataFrame operations only).

Equal texts form an atomic group; groups stand in the order of their smallest
doc_id.  The smallest capacity at which a greedy pass over the group sizes needs
no more than the given number of shards is found by binary search, and the order
is cut there.

1. Groups are counted in two levels (per scan partition, then together), so a
   text that a third of all rows hold is one row per partition.
2. Each group's end on the line of all bytes comes from distributed running
   sums (``common.totals_before``).
3. Binary search: capacities lie between the larger of the mean and the widest
   group, and the mean plus the widest group.  The midpoints that the next
   ``HALVINGS`` halvings could reach are checked together.  A greedy step asks
   for the last group end within a capacity; such an end lies at most one widest
   group away, so each step reads short stretches of the sorted ends only.
4. Cuts: the group ends nearest to equal shares, where groups wider than a share
   stand alone, so that they don't leave other shards empty.  Where a shard would
   exceed the capacity, a greedy pass from the right gives the first end at which
   each shard may stop, and cuts move between that and the capacity.
5. A document's slot is its group's rows before it in the shard, plus its place
   in the group.

Cases: a null text counts as empty (size 1, checksum 0); rows that repeat a
doc_id are rows of their own; a null doc_id sorts first; with fewer groups than
shards some shards stay empty; a group is never split, so a shard may be as
wide as the widest group; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.llm.common import cut, documents, totals_before

SHARDS = 16
#: Halvings of the capacity's range that are decided by one greedy pass.
HALVINGS = 6
#: Group ends that the driver may hold for the last halvings.
HELD = 1 << 14


def text_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum, group digest and place of every row."""
    text = F.coalesce("text", F.lit(""))
    return documents(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("at"))


def ends_below(ends: DataFrame, targets: list[int], widest: int) -> dict[int, int]:
    """Last group end not above each target (0 where there is none)."""
    targets = sorted(set(targets))
    spans: list[list[int]] = []
    for t in targets:  # an end lies within one widest group of any target
        if spans and t - widest <= spans[-1][1]:
            spans[-1][1] = t
        else:
            spans.append([t - widest, t])
    near = F.lit(False)
    for a, b in spans:
        near = near | F.col("end").between(a, b)
    place = F.size(F.filter(F.array(*[F.lit(t) for t in targets]), lambda t: t < F.col("end")))
    top = {r["k"]: r["top"] for r in ends.where(near).groupBy(place.alias("k")).agg(
        F.max("end").alias("top")).collect()}
    out, last = {}, 0
    for k, t in enumerate(targets):
        last = max(last, top.get(k, 0))
        out[t] = last
    return out


def greedy(reach, total: int, shards: int, capacities: list[int]) -> dict[int, list[int]]:
    """Where a greedy pass stops after 1 .. ``shards`` shards, per capacity;
    ``reach(targets)`` gives the last group end not above each target."""
    paths: dict[int, list[int]] = {c: [] for c in capacities}
    for j in range(shards):
        step = {c: (p[-1] if j else 0) + c for c, p in paths.items()}
        asked = [t for t in step.values() if t < total]
        found = reach(asked) if asked else {}
        for c, t in step.items():
            paths[c].append(found[t] if t < total else total)
    return paths


def smallest_capacity(ends: DataFrame, total: int, widest: int, shards: int) -> int:
    """Binary search for the smallest capacity that fits.  Each greedy stop of the
    capacities still possible lies between the stops of the two tried next to
    them: once these stretches hold ``HELD`` ends at most, those ends decide the
    remaining halvings without another job (with the same result)."""
    mean = -(-total // shards)
    low, high = max(mean, widest), min(total, mean + widest)
    held = None

    def reach(targets):
        if held is None:
            return ends_below(ends, targets, widest)
        return {t: int(held[max(np.searchsorted(held, t, side="right") - 1, 0)]) for t in targets}

    while low < high:
        step = 1 << HALVINGS
        tried = sorted({low + (high - low) * k // step for k in range(step + 1)})
        paths = greedy(reach, total, shards, tried)
        fit = next(c for c in tried if paths[c][-1] == total)
        short = [c for c in tried if c < fit]
        if not short:
            return fit
        low, high = short[-1] + 1, fit
        if held is None and low < high:
            near = F.lit(False)
            for x, y in zip(paths[short[-1]], paths[fit], strict=True):
                near = near | F.col("end").between(x, y)
            some = [r["end"] for r in ends.where(near).limit(HELD + 1).collect()]
            held = np.sort(np.array([0, *some], dtype=np.int64)) if len(some) <= HELD else None
    return high


def heavy_groups(top: list[tuple[int, int]], total: int, shards: int) -> list[tuple[int, int]]:
    """The (start, bytes) wider than an equal share of what the others leave;
    ``top``: the widest groups, as many as shards."""
    heavy: list[tuple[int, int]] = []
    for start, wide in sorted(top, key=lambda g: -g[1]):
        left = shards - len(heavy)
        if left <= 1 or wide * left <= total - sum(w for _, w in heavy):
            break
        heavy.append((start, wide))
    return heavy


def fair_targets(total: int, shards: int, heavy: list[tuple[int, int]]) -> list[int]:
    """Where shards 1 .. would start if any byte could be a cut: heavy groups
    alone, equal shares of the rest between them."""
    out, at, heavy = [], 0, sorted(heavy)
    for left in range(shards, 1, -1):
        ahead = [(start, w) for start, w in heavy if start >= at]
        if ahead and ahead[0][0] == at:
            at += ahead[0][1]
        else:
            rest = total - at - sum(w for _, w in ahead)
            at = min([at + -(-rest // max(1, left - len(ahead)))] + [start for start, _ in ahead[:1]])
        out.append(at)
    return out


def nearest_ends(ends: DataFrame, targets: list[int], widest: int, total: int) -> list[int]:
    """The group end nearest to each target (the lower of two)."""
    near = F.lit(False)
    for t in set(targets):
        near = near | F.col("end").between(t - widest, t + widest)
    ats = F.array(*[F.lit(t).cast("long") for t in targets])
    pick = ends.where(near).select("end", F.posexplode(ats).alias("k", "target")).groupBy("k").agg(
        F.max(F.when(F.col("end") <= F.col("target"), F.col("end"))).alias("below"),
        F.min(F.when(F.col("end") > F.col("target"), F.col("end"))).alias("above"))
    found = {r["k"]: (r["below"] or 0, r["above"] or total) for r in pick.collect()}
    pairs = [found[k] for k in range(len(targets))]
    return [a if t - a <= b - t else b for t, (a, b) in zip(targets, pairs, strict=True)]


def cuts_of(ends: DataFrame, total: int, widest: int, shards: int, capacity: int,
            heavy: list[tuple[int, int]]) -> list[int]:
    """Where shards 1 .. start: group ends, each shard at most ``capacity`` wide,
    as near to equal shares as that allows."""
    targets = fair_targets(total, shards, heavy)
    out = nearest_ends(ends, targets, widest, total) if targets else []
    if all(0 <= y - x <= capacity for x, y in zip([0, *out], [*out, total], strict=True)):
        return out
    first, at = [0] * (shards + 1), total  # first[j]: shard j - 1 may stop there or later
    for j in range(shards - 1, 0, -1):
        at -= capacity
        if at <= 0:
            break
        at = first[j] = ends.where(F.col("end").between(at, at + widest)).agg(F.min("end")).first()[0]
    last = 0
    for j, near in enumerate(out, 1):
        if near > last + capacity:
            near = ends_below(ends, [last + capacity], widest)[last + capacity]
        out[j - 1] = last = max(near, first[j], last)
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    rows = cut(text_rows(docs))
    runs = cut(rows.groupBy("run", "sha").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
        F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("none")))
    groups = runs.groupBy("sha").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.when(F.max("none"), F.lit(None)).otherwise(F.min("first")).alias("first"))
    placed = totals_before(groups, [F.col("first").asc_nulls_first(), F.col("sha")], start="bytes", row="n")
    placed = cut(placed.withColumn("end", F.col("start") + F.col("bytes")))
    total, widest = placed.agg(F.max("end"), F.max("bytes")).first()
    cuts: list[int] = []
    if total:
        ends = placed.select("end")
        top = [tuple(r) for r in placed.orderBy(F.desc("bytes")).limit(shards).select("start", "bytes").collect()]
        capacity = smallest_capacity(ends, total, widest, shards)
        cuts = cuts_of(ends, total, widest, shards, capacity, heavy_groups(top, total, shards))
    at = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    placed = placed.withColumn("shard", F.size(F.filter(at, lambda c: c <= F.col("start"))))
    opening = placed.groupBy("shard").agg(F.min("row").alias("opens"))  # one row per shard
    placed = placed.join(F.broadcast(opening), "shard")
    # a group's rows are numbered run by run, then inside each run
    before = W.partitionBy("sha").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    runs = runs.select("run", "sha", offset).join(placed.select("sha", "shard", (F.col("row") - F.col("opens")).alias("base")), "sha")
    place = F.row_number().over(W.partitionBy("run", "sha").orderBy(F.col("doc_id").asc_nulls_first(), "at"))
    return rows.join(runs, ["run", "sha"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        (F.col("base") + F.col("offset") + place - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
