"""Line dedup by an exact set-similarity join of lines.

A line's tokens are its distinct runs of five words (a shorter line is one
token).  A line goes if its tokens reach a Jaccard similarity of 3/4 with those
of any earlier line of the corpus; earlier is by (doc_id, digest of the text,
line number).

1. Count token loads over the corpus and order tokens by rarity.
2. Lines with equal token sets share one node; all but the first such line go.
3. Prefix and length filter: nodes that share as many of their rarest tokens as
   similar sets must, at sizes within 4/3, form islands, which hold every link
   (see ``setkit``).
4. In each island, nodes are taken in corpus order; a node first meets the
   lines that removed most so far, then an index over the rare prefixes of all
   earlier nodes, with length and positional filters; Jaccard is verified.
5. Removed lines leave their documents.

Tasks hold islands of at most ``TASK_TOKENS`` tokens and larger ones in blocks;
``LEADERS`` and ``FEW`` only choose how a node's earlier match is looked for: the
result is the same for any of them.

Cases: a null text stays null with 0 lines; lines without words always stay;
rows equal in doc_id and text count as one document and keep the same lines;
rows that repeat a doc_id with other texts are documents of their own; a null
doc_id sorts first; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm import setkit
from unilake.llm.common import cut, documents, drop
from unilake.llm.textkit import SPACE, chunks, shingle_hashes, sorted_sets, string_bytes, word_hashes

WIDTH = 5
TASK_TOKENS = 1 << 22
BAND, REACH = 1.15, 3
#: Earlier nodes that a node is compared with before the index is asked.
LEADERS = 4
#: Islands of at most this many nodes are compared without an index.
FEW = 4
_NULL_ID = -(1 << 63)
#: Bits of the filter of lines; a line's place in it is its text's digest, shifted by its number times _LINE.
_PLACES, _LINE = 1 << 26, 0x9E3779B1
_END = b"\n" * 8
_IS_WORD = bytes(not x for x in SPACE.tolist())


def _lines(text: pa.Array):
    """Per chunk: first row, rows, row and number of each line, hashes, owners."""
    if text.null_count:
        text = text.fill_null("")
    _, off = string_bytes(text)
    for i, j in chunks(np.diff(off), setkit.CHUNK):
        # a line break after each text: no line and no word runs on into the next
        one = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), text.slice(i, j - i))
        low = pc.binary_join(one, pa.scalar("\n", text.type))[0].as_buffer().to_pybytes().lower() + _END
        part, is_word = np.frombuffer(low, np.uint8), np.frombuffer(low.translate(_IS_WORD), bool)
        starts = np.r_[0, np.flatnonzero(part[:len(part) - len(_END)] == 0x0A) + 1]
        first = np.searchsorted(starts, off[i:j] - off[i] + np.arange(j - i))
        count = np.diff(np.r_[first, len(starts)])
        row, number = np.repeat(np.arange(j - i), count), np.arange(len(starts)) - np.repeat(first, count)
        edges = np.flatnonzero(np.r_[is_word[0], is_word[1:] != is_word[:-1]])
        s, e = edges[::2], edges[1::2]
        words = np.diff(np.r_[np.searchsorted(s, starts), len(s)])
        h, o = shingle_hashes(word_hashes(part, s, e), np.repeat(np.arange(len(starts)), words), WIDTH)
        yield i, j - i, row, number, h, o


def _binary(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    """The parts of an array of 64-bit numbers between the offsets, as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [
        None, pa.py_buffer((8 * off).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _line_sets(docs: DataFrame, ranks: np.ndarray, seed: int) -> DataFrame:
    """id, dig, line, n, node, check and routing keys (packed) of every line with words."""
    def run(batches):
        for batch in batches:
            ids, digs = batch.column("id").to_numpy(), batch.column("dig").to_numpy()
            for i, _, row, number, h, o in _lines(batch.column("text")):
                s = setkit.routed_sets(h, o, len(row), ranks, seed)
                full = s["n"] > 0
                cuts = np.r_[0, np.cumsum(np.diff(s["key_off"])[full])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i + row[full]]), pa.array(digs[i + row[full]]), pa.array(number[full]),
                     *[pa.array(s[c][full]) for c in ("n", "node", "check")], _binary(s["keys"], cuts)],
                    ["id", "dig", "line", "n", "node", "check", "keys"])

    return docs.mapInArrow(run, "id long, dig long, line long, n long, node long, check long, keys binary")


def _entries(lines: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches):
        def stream():
            for batch in batches:
                data, off = string_bytes(batch.column("keys"))
                lens = np.diff(off) >> 3
                yield (data.view(np.uint64),
                       np.repeat(batch.column("node").to_numpy(), lens),
                       np.repeat(batch.column("n").to_numpy(), lens))

        yield from setkit.packed_entries(stream(), n_buckets)

    return lines.select("node", "n", "keys").mapInArrow(run, setkit.ENTRY_SCHEMA)


def _token_sets(docs: DataFrame, members: DataFrame, ranks: np.ndarray, seed: int) -> DataFrame:
    """The members with their tokens, rarest first, as packed bytes.  Texts are
    cut where they are read, and only lines that a bitmap of the members' first
    lines lets through are moved."""
    at = F.col("dig").bitwiseXOR(F.col("line") * F.lit(_LINE))
    keep = setkit.bitmap(members, F.pmod(at, F.lit(_PLACES)) + F.lit(1), _PLACES)
    carried = [c for c in members.columns if c not in ("id", "dig", "line")]

    def pick(batches):
        for batch in batches:
            ids, digs = batch.column("id").to_numpy(), batch.column("dig").to_numpy()
            data, off = string_bytes(batch.column("text"))
            for i, j in chunks(np.diff(off), setkit.CHUNK):
                part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                breaks = np.flatnonzero(part == 0x0A)
                count = np.diff(np.searchsorted(breaks, at)) + 1
                starts = np.sort(np.r_[at[:-1], breaks + 1], kind="stable")
                row = np.repeat(np.arange(i, j), count)
                number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                ok = setkit.passes(keep, ((digs[row] ^ (number * _LINE)) & (_PLACES - 1)) + 1)
                # a line takes its line break along
                lines = pa.Array.from_buffers(pa.string(), len(row), [
                    None, pa.py_buffer(np.r_[starts, at[-1]].astype(np.int32)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row[ok]]), pa.array(digs[row[ok]]), pa.array(number[ok]), lines.filter(pa.array(ok))],
                    ["id", "dig", "line", "text"])

    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for i, m, row, number, h, o in _lines(batch.column("text")):
                flat, off = sorted_sets(h, o, len(row), ranks[setkit.hash_group(h)])
                own = np.flatnonzero(number == 0)  # behind a line break there is nothing
                ok = pa.array(setkit.set_digests(flat, off, seed).view(np.int64)[own] == nodes[i:i + m])
                tokens = _binary(flat, np.r_[off[own], off[-1]])
                yield pa.RecordBatch.from_arrays(
                    [x.filter(ok) for x in (*[batch.column(c).slice(i, m) for c in carried], tokens)],
                    [*carried, "tokens"])

    some = docs.select("id", "dig", "text").mapInArrow(pick, "id long, dig long, line long, text string")
    kinds = ", ".join(f"{c} {t}" for c, t in members.dtypes if c in carried)
    return some.join(members, ["id", "dig", "line"]).select("text", *carried).mapInArrow(run, f"{kinds}, tokens binary")


def later_matches(sets: list[np.ndarray], removed: list[bool], side: list[int] | None = None) -> list[int]:
    """Positions of the sets that match an earlier one (3/4 Jaccard).

    ``sets``: distinct tokens, rarest first, in corpus order.  Those in
    ``removed`` are known to go and are only looked for, not looked up; with
    ``side`` only sets of different sides are compared.
    """
    sorted_: dict[int, np.ndarray] = {}
    index: dict[int, list[tuple[int, int]]] = defaultdict(list)
    hits: Counter[int] = Counter()
    out = []

    def matches(x, y):
        n, m = len(sets[x]), len(sets[y])
        if 4 * min(n, m) < 3 * max(n, m):
            return False
        a, b = (sorted_[k] if k in sorted_ else sorted_.setdefault(k, np.sort(sets[k])) for k in (x, y))
        both = int((b[np.minimum(np.searchsorted(b, a), m - 1)] == a).sum())
        return 7 * both >= 3 * (n + m)

    def partner(x, prefix):
        n = len(sets[x])
        for y, _ in hits.most_common(LEADERS):
            if (side is None or side[x] != side[y]) and matches(x, y):
                return y
        seen: dict[int, int] = {}
        for i, token in enumerate(prefix):
            for y, j in index.get(token, ()):
                m = len(sets[y])
                if 4 * min(n, m) < 3 * max(n, m) or side is not None and side[x] == side[y]:
                    continue
                common = seen.get(y, 0)
                # positional filter: the most tokens that may still be shared
                if common >= 0:
                    ok = 7 * (common + 1 + min(n - i, m - j) - 1) >= 3 * (n + m)
                    seen[y] = common + 1 if ok else -1
        return next((y for y, c in sorted(seen.items()) if c > 0 and matches(x, y)), None)

    if len(sets) <= FEW:  # no index for a handful
        return [x for x in range(len(sets)) if not removed[x] and any(
            (side is None or side[x] != side[y]) and matches(x, y) for y in range(x))]
    for x, tokens in enumerate(sets):
        n = len(tokens)
        prefix = tokens[:n - (3 * n + 3) // 4 + 1].tolist()
        if not removed[x]:
            y = partner(x, prefix)
            if y is not None:
                out.append(x)
                hits[y] += 1
        for i, token in enumerate(prefix):
            index[token].append((x, i))
    return out


def _flag(sets: DataFrame) -> DataFrame:
    """Nodes that match an earlier node of their island and task."""
    def run(pdf):
        pdf = pdf.drop_duplicates(["island", "node"]).sort_values(["island", "fid", "fdig", "fline"], kind="stable")
        island, node = pdf["island"].to_numpy(), pdf["node"].to_numpy()
        side, gone = pdf["side"].tolist(), pdf["gone"].tolist()
        tokens = [np.frombuffer(t, dtype=np.uint64) for t in pdf["tokens"]]
        cuts = np.flatnonzero(np.r_[True, island[1:] != island[:-1], True]).tolist()
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = side[a:b]
            found = later_matches(tokens[a:b], gone[a:b], own if len(set(own)) > 1 else None)
            out += [int(node[a + x]) for x in found]
        return pd.DataFrame({"node": pd.Series(out, dtype="int64")})

    return sets.groupBy("task").applyInPandas(run, "node long")


def _removed_nodes(docs: DataFrame, nodes: DataFrame, ranks: np.ndarray, seed: int) -> DataFrame:
    """Nodes whose first line matches an earlier line."""
    tokens = nodes.agg(F.sum("n")).first()[0] or 0
    bins = max(16, int(tokens // (TASK_TOKENS // 8)) + 1)
    sized = nodes.join(nodes.groupBy("island").agg(F.sum("n").alias("total")), "island")
    base = sized.select("id", "dig", "line", "node", "n", "island", F.col("id").alias("fid"),
                        F.col("dig").alias("fdig"), F.col("line").alias("fline"), "total")
    small = cut(base.where(F.col("total") <= TASK_TOKENS).select(
        "id", "dig", "line", "node", "island", "fid", "fdig", "fline", F.lit(False).alias("gone"), F.lit(0).alias("side"),
        F.pmod(F.xxhash64("island"), F.lit(bins)).cast("string").alias("task")))
    large = cut(base.where(F.col("total") > TASK_TOKENS).drop("total"))
    gone = cut(_flag(_token_sets(docs, small, ranks, seed)))
    drop(small)
    if large.isEmpty():
        drop(large)
        return gone
    # blocks by size band and hash: each by itself and with the first block of
    # its band first, then all pairs that still hold an undecided node
    whole = large
    large = large.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(BAND))))
    per = large.groupBy("island", "band").agg(F.sum("n").alias("tokens")).select(
        "island", "band", F.ceil(F.col("tokens") / F.lit(TASK_TOKENS // 2)).alias("slices"))
    large = large.join(per, ["island", "band"]).withColumn(
        "slice", F.pmod(F.xxhash64("node"), F.col("slices"))).drop("slices", "n")
    large = cut(large)
    drop(whole)
    sets = cut(_token_sets(docs, large, ranks, seed))
    drop(large)
    key = ["island", "band", "slice"]
    blocks = cut(sets.select(key).distinct())
    pairs = cut(blocks.toDF("island", "ba", "sa").join(blocks.toDF("island", "bb", "sb"), "island").where(
        (F.col("bb") - F.col("ba")).between(0, REACH)
        & ((F.col("ba") < F.col("bb")) | (F.col("sa") <= F.col("sb")))))
    first = F.expr("ba = bb and (sa = sb or sa = 0)")
    flagged = None
    for chosen in (pairs.where(first), pairs.where(~first)):
        if flagged is None:
            state = sets.withColumn("gone", F.lit(False)).drop("side", "task")
        else:
            state = sets.drop("gone", "side", "task").join(flagged.withColumn("gone", F.lit(True)), "node", "left") \
                .withColumn("gone", F.coalesce("gone", F.lit(False)))
            left = cut(state.groupBy(key).agg(F.bool_and("gone").alias("done")))
            chosen = chosen.join(left.toDF("island", "ba", "sa", "da"), ["island", "ba", "sa"]).join(
                left.toDF("island", "bb", "sb", "db"), ["island", "bb", "sb"]).where("not (da and db)")
        task = F.concat_ws(":", "island", "ba", "sa", "bb", "sb").alias("task")
        same = F.expr("ba = bb and sa = sb")
        to = chosen.select("island", F.col("ba").alias("band"), F.col("sa").alias("slice"), task, F.lit(0).alias("side")) \
            .union(chosen.where(~same).select("island", "bb", "sb", task, F.lit(1)))
        found = _flag(state.join(to, key)).distinct()
        before, flagged = flagged, cut(found if flagged is None else found.union(flagged).distinct())
        drop(before)
    out = cut(gone.union(flagged))
    drop(sets, blocks, pairs, gone, flagged)
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text without its later matches, n_lines and the removed lines'
    numbers of every document."""
    docs = documents(docs, "doc_id", "text")
    key = [F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("dig")]
    keyed = docs.select(*key, "text")

    def hashes(batch):
        return (h for *_, h, _ in _lines(batch.column("text")))

    ranks = setkit.load_ranks(setkit.group_totals(keyed.select("text"), hashes))
    seed = 0
    while True:
        lines = cut(_line_sets(keyed, ranks, seed))
        nodes = cut(lines.groupBy("node").agg(
            F.min(F.struct("id", "dig", "line")).alias("first"), F.min("n").alias("n"), F.max("n").alias("n1"),
            F.min("check").alias("c0"), F.max("check").alias("c1"), F.count(F.lit(1)).alias("copies")))
        if nodes.where("c0 <> c1 or n <> n1").isEmpty():
            break
        drop(lines, nodes)
        seed += 1  # two sets had one digest: hash them anew
    tokens = nodes.agg(F.sum("n")).first()[0] or 0
    island = setkit.islands(_entries(lines, max(256, int(tokens // 4_000_000) + 1)))
    members = cut(nodes.select("node", "n", "first.id", "first.dig", "first.line").join(
        island.withColumnRenamed("component", "island"), "node"))
    drop(island)
    gone = cut(_removed_nodes(keyed, members, ranks, seed).distinct().withColumn("gone", F.lit(True)))
    drop(members)
    # only nodes that go or have further lines take part; a lone line stays or goes with its node
    known = cut(nodes.where("copies > 1").select("node", "first").join(gone, "node", "full"))
    drop(nodes, gone)
    out = cut(lines.select("id", "dig", "line", "node").join(known, "node").where(
        "gone or id <> first.id or dig <> first.dig or line <> first.line").groupBy("id", "dig").agg(
            F.sort_array(F.collect_set("line")).alias("removed")))

    def rebuild(batches):
        for batch in batches:
            texts, removed = batch.column("text"), [r or [] for r in batch.column("removed").to_pylist()]
            cut_ = np.array([len(r) > 0 for r in removed], dtype=bool)
            new = []
            for t, r in zip(texts.filter(pa.array(cut_)).to_pylist(), (r for r in removed if r), strict=True):
                gone = set(r)
                new.append("\n".join([p for k, p in enumerate(t.split("\n")) if k not in gone]))
            count = pc.add(pc.fill_null(pc.count_substring(texts, "\n"), -1), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.replace_with_mask(texts, pa.array(cut_), pa.array(new, pa.string())),
                 count.cast(pa.int64()), pa.array(removed, pa.list_(pa.int64()))],
                ["doc_id", "text", "n_lines", "removed_lines"])

    drop(lines, known)
    both = docs.select("doc_id", "text", *key).join(out, ["id", "dig"], "left")
    return both.select("doc_id", "text", "removed").mapInArrow(
        rebuild, "doc_id long, text string, n_lines long, removed_lines array<long>")
