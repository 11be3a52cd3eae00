"""Hard-negative mining by segment summary filtering.

A vector is cut into segments; a segment's mean and deviation (length of what
the mean leaves) bound its share of an inner product: the means' product times
the segment's length, plus or minus the deviations' product.  Bounds of few
segments are refined by more segments, for the rows that may still matter, and
only then are scores computed exactly.

1. Rows are dealt by hash to blocks of bounded bytes, packed with the summaries
   of every level; a label's rows lie together inside a block.
2. Anchors are dealt to tiles.  Every tile meets every block in a task of its own
   (a stated query set against all rows, in blocks): tiles and blocks are bounded,
   whatever a label's share of the rows.
3. First pass: each anchor's best rows of its own label (positives).  A lower
   bound that enough rows reach drops all rows whose upper bound is below it.
4. Second pass: per anchor and positive, the best rows of other labels whose
   scores lie in the positive's window.  The rows certainly inside the window give
   the floor; rows whose bounds miss the window or the floor are dropped.
5. Each task gives at most the asked number of rows per anchor (and positive);
   a ranked window over these decides.

Components become floor(``scale`` * x); scores are exact integers.

Cases: rows without a vec_id, with a null label or vector, an empty vector, or
a component that is null or not finite (also after scaling) take no part; vectors
of different lengths don't meet; equal scores are ordered by vec_id; rows that
repeat a vec_id are rows of their own (one may be the other's positive, both may
be anchors); an anchor without positives gives no rows; scores beyond 64 bits are
cut to the largest or smallest; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.llm.common import cut

#: Segments per level, fewest first.
LEVELS = (1, 4, 16)
#: Rows of a block and anchors of a tile, at most, and bytes of a block.
BLOCK_ROWS, TILE_ROWS, BLOCK_BYTES = 16384, 16384, 1 << 24
POSITIVES, NEGATIVES = 5, 10
#: Negatives lie between these hundredths of the positive's score.
LEAST, MOST = 30, 90
_EXACT = float(1 << 53)
_INT64 = (-(1 << 63), (1 << 63) - 1)


def summaries(x: np.ndarray) -> list[np.ndarray]:
    """Per level, every row's means (times the root of the segment's length)
    and deviations, side by side."""
    out = []
    for segments in LEVELS:
        at = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
        size = np.diff(at)
        mean = np.add.reduceat(x, at[:-1], axis=1) / size
        off = np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, at[:-1], axis=1)
        out.append(np.concatenate([mean * np.sqrt(size), np.sqrt(off)], axis=1))
    return out


def bounds(rows: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of the summarised rows with ``own``."""
    k = len(own) // 2
    mid, span = rows[:, :k] @ own[:k], rows[:, k:] @ own[k:]
    span = span + 1e-9 * (np.abs(mid) + span) + 1e-6  # rounding
    # sums may cancel: the means' products enter by their sizes as well
    span += 1e-12 * (np.abs(rows[:, :k]) @ np.abs(own[:k]))
    return mid - span, mid + span


def scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; ``exact``: doubles hold all their partial sums."""
    if exact:
        return (x @ q).astype(np.int64)
    own = [int(v) for v in q]
    got = [sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in x]
    return np.array([min(max(s, _INT64[0]), _INT64[1]) for s in got], dtype=np.int64)


class Block:
    """Packed rows: vectors, identifiers and summaries."""

    def __init__(self, rec: dict):
        n = rec["n"]
        self.ids = np.frombuffer(rec["ids"], dtype=np.int64)
        self.rows = np.frombuffer(rec["rows"], dtype=np.int64)
        self.labels = np.frombuffer(rec["labels"], dtype=np.int64)
        self.x = np.frombuffer(rec["x"], dtype=np.float64).reshape(n, -1)
        flat, at, self.levels = np.frombuffer(rec["summaries"], dtype=np.float64), 0, []
        for s in LEVELS:
            width = 2 * min(s, self.x.shape[1])
            self.levels.append(flat[at:at + n * width].reshape(n, width))
            at += n * width
        self.largest = float(np.abs(self.x).max(initial=0.0))

    @staticmethod
    def pack(pdf: pd.DataFrame) -> dict:
        """Rows of one block, in the order of their labels."""
        x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["v"]])
        with np.errstate(over="ignore", invalid="ignore"):
            flat = np.concatenate([s.reshape(-1) for s in summaries(x)])
        return {"n": len(x), "ids": pdf["vec_id"].to_numpy(np.int64).tobytes(),
                "rows": pdf["row"].to_numpy(np.int64).tobytes(),
                "labels": pdf["label"].to_numpy(np.int64).tobytes(),
                "x": x.tobytes(), "summaries": flat.tobytes()}


class Best:
    """The first ``k`` rows, by score and then vec_id, inside a window of scores."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.floor = -np.inf

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which rows may still be among the first ``k``, by their scores' bounds."""
        sure = low[(low >= self.low) & (high <= self.high)]
        if len(sure) >= self.k:
            self.floor = max(self.floor, float(np.partition(sure, len(sure) - self.k)[len(sure) - self.k]))
        return (high >= max(self.low, self.floor)) & (low <= self.high)

    def first(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        at = np.flatnonzero((score >= self.low) & (score <= self.high))
        return at[np.lexsort((rows[at], ids[at], ~score[at]))][:self.k]


def search(block: Block, tile: Block, a: int, at: np.ndarray, wanted: list[Best]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per wanted window, (rows of the block, scores) of anchor ``a`` of the
    tile among the rows ``at``, by ever finer bounds, then exactly."""
    d = block.x.shape[1]
    exact = block.largest * tile.largest * d < _EXACT
    if exact:  # larger values overflow the summaries: such rows are all scored
        for rows, own in zip(block.levels, tile.levels, strict=True):
            if not len(at):
                break
            low, high = bounds(rows[at], own[a])
            at = at[np.logical_or.reduce([b.open(low, high) for b in wanted])]
    score = scores(block.x[at], tile.x[a], exact)
    out = []
    for b in wanted:
        i = b.first(score, block.ids[at], block.rows[at])
        out.append((at[i], score[i]))
    return out


def _packed(rows: DataFrame, salt: int, per: Column) -> DataFrame:
    """``rows`` dealt by hash to packs of ``per`` rows of one vector length;
    a column ``asked`` (a list per row) is packed along."""
    extra = "asked" in rows.columns
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.first(per)).alias("packs"))
    place = F.pmod(F.xxhash64("row", F.lit(salt)), F.col("packs"))

    def pack(pdf):
        pdf = pdf.sort_values(["label", "row"], kind="stable")
        rec = {"dim": pdf["dim"].iloc[0], "place": pdf["place"].iloc[0], **Block.pack(pdf)}
        return pd.DataFrame([rec | {"asked": [list(x) for x in pdf["asked"]]} if extra else rec])

    return rows.join(sizes, "dim").withColumn("place", place).groupBy("dim", "place").applyInPandas(
        pack, "dim int, place long, n long, ids binary, rows binary, labels binary, x binary, summaries binary"
              + (", asked array<array<long>>" if extra else ""))


_PACK = ["n", "ids", "rows", "labels", "x", "summaries"]


def _tasks(blocks: DataFrame, tiles: DataFrame, run, schema: str) -> DataFrame:
    """``run(block, tile record)`` for every block and tile of one length; each
    pair is one cogroup of one block and one tile."""
    n_blocks = blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("k"))
    n_tiles = tiles.groupBy("dim").agg(F.count(F.lit(1)).alias("k"))
    all_ = F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))
    # blocks and tiles are numbered anew without gaps, as hashing may leave some empty
    number = F.row_number().over(W.partitionBy("dim").orderBy("place")).cast("long") - 1
    left = blocks.join(blocks.select("dim", "place", number.alias("block")), ["dim", "place"]) \
        .join(n_tiles, "dim").select("dim", "block", all_.alias("tile"), *_PACK)
    right = tiles.join(tiles.select("dim", "place", number.alias("tile")), ["dim", "place"]) \
        .join(n_blocks, "dim").select("dim", all_.alias("block"), "tile", *[c for c in tiles.columns if c not in ("dim", "place")])
    key = ["dim", "block", "tile"]

    def both(_, b, t):
        rows = [r for x in b.to_dict("records") for y in t.to_dict("records") for r in run(Block(x), Block(y), y)]
        return pd.DataFrame(rows, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(both, schema)


def mine(table: DataFrame, anchor: Column, label: Column | None = None, scale: int = 256,
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    ``anchor``: condition on vec_id and label that makes a row an anchor.
    ``label``: the label that counts, if it isn't the column as it is.  Negatives'
    scores lie within ``least`` and ``most`` hundredths of the positive's.
    """
    spark = table.sparkSession
    v = table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].cast("array<double>").alias("v"),
                     table["label"].cast("long").alias("label"))
    v = v.withColumn("anchor", F.coalesce(anchor, F.lit(False)))
    if label is not None:
        v = v.withColumn("label", label.cast("long"))
    v = v.withColumn("v", F.transform("v", lambda x: x * F.lit(float(scale))))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite
    # floor of a double as a double: a whole number of any size
    whole = F.transform("v", lambda x: F.when(F.abs(x) < F.lit(_EXACT), F.floor(x).cast("double")).otherwise(x))
    v = cut(v.where(good).select("vec_id", "label", "anchor", whole.alias("v"), F.size("v").alias("dim"),
                                 F.monotonically_increasing_id().alias("row")))
    per_block = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8))))
    blocks = cut(_packed(v.drop("anchor"), 0, per_block))
    # enough tiles to keep all cores busy, and no more than tiles of TILE_ROWS
    anchors = v.where("anchor")
    busy = 4 * spark.sparkContext.defaultParallelism
    n_anchors, n_blocks = anchors.count(), max(1, blocks.count())
    per_tile = F.least(per_block, F.lit(min(TILE_ROWS, max(64, -(-n_anchors * n_blocks // busy)))))
    anchors = anchors.drop("anchor")
    tiles = cut(_packed(anchors, 1, per_tile))

    def own_label(block: Block, tile: Block, _):
        for a in range(len(tile.ids)):
            i, j = np.searchsorted(block.labels, [tile.labels[a], tile.labels[a] + 1])
            at = np.arange(i, j)
            at = at[block.rows[at] != tile.rows[a]]
            (got, score), = search(block, tile, a, at, [Best(positives, -np.inf, np.inf)])
            for k, s in zip(got.tolist(), score.tolist(), strict=True):
                yield tile.rows[a], tile.ids[a], block.ids[k], s, block.rows[k]

    found = _tasks(blocks, tiles, own_label, "anchor long, anchor_id long, id long, score long, row long")
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    best = cut(found.withColumn("k", F.row_number().over(W.partitionBy("anchor").orderBy(*order)))
               .where(F.col("k") <= positives))
    asked = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("k", "score"))).alias("w"))
    asked = asked.select(F.col("anchor").alias("row"), F.col("w.score").alias("asked"))
    tiles = cut(_packed(anchors.join(asked, "row"), 1, per_tile))

    def other_labels(block: Block, tile: Block, rec):
        for a in range(len(tile.ids)):
            i, j = np.searchsorted(block.labels, [tile.labels[a], tile.labels[a] + 1])
            at = np.r_[0:i, j:len(block.ids)]
            ps = [int(s) for s in rec["asked"][a]]
            wanted = [Best(negatives, -(-least * s // 100), most * s // 100) for s in ps]
            live = [k for k, b in enumerate(wanted) if b.low <= b.high]
            if not live:
                continue
            for k, (got, score) in zip(live, search(block, tile, a, at, [wanted[k] for k in live]), strict=True):
                for r, s in zip(got.tolist(), score.tolist(), strict=True):
                    yield tile.rows[a], k + 1, block.ids[r], s, block.rows[r]

    found = _tasks(blocks, tiles, other_labels, "anchor long, k int, id long, score long, row long")
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("anchor", "k").orderBy(*order))) \
        .where(F.col("rank") <= negatives)
    pos = best.select("anchor", "k", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pos, ["anchor", "k"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
