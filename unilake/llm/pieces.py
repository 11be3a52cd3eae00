"""SentencePiece encoding and decoding by unigram Viterbi.

Pieces and scores come from a model file.  White space becomes the marker
U+2581 and one marker is put in front.  Pieces hold markers only at their
start, so a text falls apart exactly into units (markers, then other
characters); each distinct unit of a chunk is encoded once.  All units of a
chunk advance together: their start positions walk a double-array trie over
UTF-8 bytes, and the Viterbi recurrence runs over the end positions.  A
character without a piece falls back to its byte pieces at a score below any
piece's.  Of equal scores, the longest last piece wins.

Cases: a null text gives null ids and null text; an empty text gives no ids; decoding restores
the text exactly unless it holds U+2581 itself, which becomes a space; rows
that repeat a doc_id are encoded one by one; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from unilake.llm.common import bound_batches, documents
from unilake.llm.textkit import chunks, span_hashes, string_bytes

MARK = "▁"
CHUNK = 1 << 18
#: Units whose ids a task keeps (about 25 MB).
CACHED = 1 << 17


class DoubleArray:
    """Byte trie in two arrays: the child of node s by byte b is base[s] + b + 1
    if check there is s."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        size = 1 << 12
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, -1, dtype=np.int32)
        self.value = np.full(size, -1, dtype=np.int32)
        self.check[0] = 0
        taken = bytearray(size)
        taken[0] = 1
        lowest, ahead = 1, 0
        todo = [(0, 0, len(keys), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if len(keys[lo][0]) == depth:
                self.value[node] = keys[lo][1]
                lo += 1
            kids, i = [], lo
            while i < hi:
                b = keys[i][0][depth]
                j = i + 1
                while j < hi and keys[j][0][depth] == b:
                    j += 1
                kids.append((b, i, j))
                i = j
            if not kids:
                continue
            # single children fill the gaps; larger families look only ahead
            if len(kids) == 1:
                lowest = taken.find(0, max(lowest, kids[0][0] + 1))
                base = lowest - kids[0][0] - 1
            else:
                base = ahead
                while any(taken[base + b + 1] for b, _, _ in kids):
                    base += 1
                ahead = max(ahead, base - 64)
            if base + 1200 > len(taken):
                taken.extend(bytes(len(taken)))
            if len(taken) > len(self.base):
                more = len(taken) - len(self.base)
                self.base = np.r_[self.base, np.zeros(more, np.int32)]
                self.check = np.r_[self.check, np.full(more, -1, np.int32)]
                self.value = np.r_[self.value, np.full(more, -1, np.int32)]
            self.base[node] = base
            for b, i, j in kids:
                at = base + b + 1
                taken[at] = 1
                self.check[at] = node
                todo.append((at, i, j, depth + 1))


class Pieces:
    """What encoding and decoding need of a model file."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.trie = DoubleArray([(pieces[i].encode(), i) for i in normal])
        self.scores = np.array(scores, dtype=np.float64)
        self.unknown = kinds.index("unknown")
        self.unknown_score = min((scores[i] for i in normal), default=0.0) - 10.0
        self.byte_id = np.full(256, -1, dtype=np.int32)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[int(pieces[i][3:5], 16)] = i
        self.inner_marks = any(MARK in pieces[i].lstrip(MARK) for i in normal)
        self.spelled = [bytes([int(p[3:5], 16)]) if k == "byte" else p.encode() if k == "normal"
                        else " ⁇ ".encode() if k == "unknown" else b""
                        for p, k in zip(pieces, kinds, strict=True)]

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        kinds = ["unknown" if m.is_unknown(i) else "byte" if m.is_byte(i) else
                 "other" if m.is_control(i) or m.is_unused(i) else "normal" for i in range(n)]
        return cls([m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], kinds)

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all units in a row, and offsets."""
        return self.encode_packed(np.frombuffer(b"\0".join(units) + b"\0", dtype=np.uint8),
                                  np.array([len(u) for u in units], dtype=np.int64))

    def encode_packed(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_units``; ``raw`` holds the units, a zero byte behind each."""
        stop = np.cumsum(sizes + 1) - 1            # of each unit, in raw
        first = stop - sizes
        unit_stop = np.repeat(stop, sizes + 1).astype(np.int32)
        inside = np.ones(len(raw), dtype=bool)
        inside[stop] = False
        starts = np.flatnonzero(inside & ((raw & 0xC0) != 0x80)).astype(np.int32)
        char_end = np.minimum(np.r_[starts[1:], np.int32(len(raw))], unit_stop[starts])
        # every match of a piece: start, end, id
        found, at, to_end, node, depth = [], starts, char_end, np.zeros(len(starts), np.int32), 0
        spelt = np.zeros(len(raw), dtype=bool)     # starts of characters that are pieces
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        while len(at):
            to = base[node] + raw[at + depth] + 1
            ok = np.flatnonzero(check.take(to, mode="clip") == node)   # the last place is never taken
            at, to_end, node = at[ok], to_end[ok], to[ok]
            depth += 1
            piece = value[node]
            hit = np.flatnonzero(piece >= 0)
            begin = at[hit]
            spelt[begin[to_end[hit] == begin + depth]] = True
            found.append((begin, begin + np.int32(depth), piece[hit]))
            more = np.flatnonzero(at + depth < unit_stop[at])
            at, to_end, node = at[more], to_end[more], node[more]
        # other characters; a piece of one character always beats its bytes
        bare = np.flatnonzero(~spelt[starts])
        found.append((starts[bare], char_end[bare], np.full(len(bare), -1, np.int32)))
        start, end, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        # by (end in the unit, end, start): an end has one place in its unit
        rel = end - np.repeat(first, sizes + 1).astype(np.int32)[start]
        size = end - start
        longest = int(size.max(initial=0)) + 1
        order = np.argsort((rel.astype(np.int64) * (len(raw) + 1) + end) * longest + (longest - 1 - size))
        start, end, piece, rel = start[order], end[order], piece[order], rel[order]
        gain = np.where(piece >= 0, self.scores[piece], self.unknown_score)
        best = np.full(len(raw) + 1, -np.inf)
        best[first] = 0.0
        via = np.zeros(len(raw) + 1, dtype=np.int32)
        level = np.flatnonzero(np.r_[True, rel[1:] != rel[:-1]]) if len(rel) else np.zeros(0, np.int64)
        for lo, hi in zip(level.tolist(), np.r_[level, len(rel)][1:].tolist(), strict=True):
            total = best[start[lo:hi]] + gain[lo:hi]
            e = end[lo:hi]
            head = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
            top = np.maximum.reduceat(total, head)
            group = np.cumsum(np.r_[0, e[1:] != e[:-1]])
            win = np.flatnonzero(total == top[group])
            win = win[np.r_[True, group[win][1:] != group[win][:-1]]]
            best[e[win]] = top
            via[e[win]] = lo + win
        # follow the best path of every unit from its end
        unit, now, steps = np.flatnonzero(sizes > 0), stop[sizes > 0], []
        while len(unit):
            m = via[now]
            steps.append((unit, m))
            now = start[m]
            more = now > first[unit]
            unit, now = unit[more], now[more]
        if not steps:
            return np.zeros(0, np.int32), np.zeros(len(sizes) + 1, np.int64)
        unit = np.concatenate([u for u, _ in steps])
        m = np.concatenate([x for _, x in steps])
        order = np.lexsort((start[m], unit))
        unit, m = unit[order], m[order]
        # an unknown character is spelled in byte pieces
        width = np.where((piece[m] < 0) & (self.byte_id[0] >= 0), end[m] - start[m], 1)
        pos = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        own = np.repeat(m, width)
        ids = np.where(piece[own] >= 0, piece[own], self.byte_id[raw[start[own] + pos]])
        ids = np.where(ids < 0, self.unknown, ids).astype(np.int32)
        return ids, np.r_[0, np.cumsum(np.bincount(np.repeat(unit, width), minlength=len(sizes)))]

    def encode(self, texts: list[str], cache: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts in a row, and offsets; each distinct unit is
        encoded once.  ``cache`` keeps units' ids between calls."""
        marked = [(MARK + t.replace(" ", MARK)).encode() if t else b"" for t in texts]
        raw = np.frombuffer(b"".join(marked), dtype=np.uint8)
        off = np.r_[0, np.cumsum([len(t) for t in marked])].astype(np.int64)
        del marked
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        start = np.zeros(len(raw), dtype=bool)
        start[off[:-1][off[:-1] < off[1:]]] = True
        if not self.inner_marks:
            m0, m1, m2 = MARK.encode()
            mark = np.flatnonzero(raw[:-2] == m0)
            mark = mark[(raw[mark + 1] == m1) & (raw[mark + 2] == m2)]
            start[mark[np.r_[True, mark[1:] != mark[:-1] + 3]]] = True
        s = np.flatnonzero(start)
        e = np.r_[s[1:], len(raw)]
        keys, one, which = np.unique(span_hashes(raw, s, e), return_index=True, return_inverse=True)
        keys = keys.tolist()
        known = [cache.get(k) for k in keys]
        new = [i for i, x in enumerate(known) if x is None]
        # the new units' bytes, each with a zero behind it
        a, sizes = s[one[new]], (e - s)[one[new]]
        from_ = np.arange(int(sizes.sum()) + len(new)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1 - a, sizes + 1)
        packed = raw.take(from_, mode="clip")
        packed[np.cumsum(sizes + 1) - 1] = 0
        del from_
        ids, uoff = self.encode_packed(packed, sizes)
        raw, cuts = ids.tobytes(), (uoff * 4).tolist()
        if len(cache) + len(new) > CACHED:
            cache.clear()
        for i, a, b in zip(new, cuts, cuts[1:], strict=False):
            known[i] = cache[keys[i]] = raw[a:b]
        ids = np.frombuffer(b"".join(known), dtype=np.int32)
        uoff = np.r_[0, np.cumsum([len(x) // 4 for x in known])]
        lens = np.diff(uoff)[which]
        first = np.cumsum(lens) - lens
        out = ids[np.arange(int(lens.sum())) + np.repeat(uoff[which] - first, lens)]
        cuts = np.r_[0, np.cumsum(lens)][np.searchsorted(s, off)]
        return out, cuts

    def decode(self, ids) -> str:
        text = b"".join([self.spelled[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def encode_decode(docs: DataFrame, path: str, carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, ids, n_ids, decoded (the text from the ids alone) and the carried columns."""
    bound_batches(docs.sparkSession, 1 << 22)
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))

    def run(batches):
        p, cache = pieces.value, {}
        for batch in batches:
            text = batch.column("text")
            sizes = np.diff(string_bytes(text)[1])
            for i, j in chunks(sizes, CHUNK):
                own = text.slice(i, j - i)
                ids, off = p.encode([t or "" for t in own.to_pylist()], cache)
                back = [p.decode(ids[a:b].tolist()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                null = np.asarray(own.is_null())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids), mask=pa.array(null)),
                     pa.array(np.diff(off), pa.int64(), mask=null), pa.array(back, pa.string(), mask=null),
                     *[batch.column(c).slice(i, j - i) for c in carried]],
                    ["doc_id", "ids", "n_ids", "decoded", *carried])

    rows = documents(docs, "doc_id", "text", *carried)
    kinds = "".join(f", `{c}` {t}" for c, t in rows.dtypes[2:])
    return rows.mapInArrow(run, f"doc_id long, ids array<int>, n_ids long, decoded string{kinds}")
