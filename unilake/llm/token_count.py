"""Token counts of a byte-level BPE without materialising ids.

1. Pre-tokenise every text (the vocabulary's split rule, vectorised over code
   points) and gather the distinct pre-tokens of the corpus with frequencies.
2. Count the pieces of every distinct pre-token once, with the library.
3. Pre-tokenise again into per-document pre-token frequencies and join them
   with the counts.  The most frequent pre-tokens (``HOT`` at most) are joined
   inside the tasks; all others are joined by a shuffle, where none is hot.
4. Sum per document.

Special strings inside a text are one token each, and cut the text, as the
library does by default.

Cases: a null text counts as empty and has 0 tokens; rows that repeat a doc_id
are counted one by one; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm.common import bound_batches, cut, documents, drop
from unilake.llm.textkit import chunks, span_hashes, string_bytes

#: Pre-tokens whose counts every task holds: at most this many (3 MB).
HOT = 1 << 18
#: Distinct pre-tokens gathered in a task before they are passed on.
GATHER = 1 << 19
CHUNK = 1 << 19
#: Pre-tokens that the library counts at a time.
SLICE = 2000
LIMIT = 1024
_SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_QUOTE = 0x27
#: Seed of the check digests, apart from those of the hashes.
_CHECK = 1000


def class_table(source: str) -> np.ndarray:
    """Code point -> SPACE, LETTER, NUMBER or OTHER, as the library of the
    vocabulary ``source`` has it: its Unicode may be newer than Python's, so
    code points that Python doesn't know are asked of the library."""
    from tokenizers import Tokenizer

    out = np.full(0x110000, OTHER, dtype=np.uint8)
    unknown = []
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            out[i] = LETTER
        elif kind[0] == "N":
            out[i] = NUMBER
        elif kind == "Cn" and i < 0x40000:  # beyond: private or never assigned
            unknown.append(i)
    library = Tokenizer.from_str(source).pre_tokenizer
    for kind, sample in ((LETTER, "a"), (NUMBER, "1")):
        text = "".join(f" {sample}{chr(i)}" for i in unknown)
        starts = np.zeros(len(text) + 1, dtype=bool)
        starts[[a for _, (a, _) in library.pre_tokenize_str(text)]] = True
        out[np.array(unknown)[~starts[2:len(text):3]]] = kind
    out[_SPACES] = SPACE
    return out


def pretoken_starts(codes: np.ndarray, off: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; ``off`` cuts the texts.

    The split rule: contractions 's 't 're 've 'm 'll 'd; runs of letters, of
    numbers and of other characters, each with one space before it; white
    space, whose last character before other text stands apart.
    """
    n = len(codes)
    start = np.zeros(n + 1, dtype=bool)
    if not n:
        return start[:0]
    c = classes[codes]
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[off] = True
    run = text_start.copy()
    run[1:n] |= c[1:] != c[:-1]
    start |= run
    first = np.flatnonzero(run[:n])
    end = np.r_[first[1:], n]
    # the last white space before other text of the same text
    gap = (c[first] == SPACE) & ~text_start[end]
    last = end[gap] - 1
    start[last] = True
    joins = codes[last] == 0x20
    start[end[gap][joins]] = False
    # contractions: a lone quote that starts a pre-token, then letters
    lone = first[(end - first == 1) & (codes[first] == _QUOTE)]
    lone = lone[start[lone] & (lone + 1 < n)]
    lone = lone[~text_start[lone + 1]]
    lone = lone[c[lone + 1] == LETTER]
    if len(lone):
        stop = end[np.searchsorted(first, lone + 1)]
        a = codes[lone + 1]
        b = np.where(lone + 2 < stop, codes[np.minimum(lone + 2, n - 1)], 0)
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) \
            | ((a == ord("l")) & (b == ord("l")))
        size = np.where(one, 1, np.where(two, 2, 0))
        hit = size > 0
        start[lone[hit] + 1] = False
        start[lone[hit] + 1 + size[hit]] = True
    return start[:n]


def _segments(text: pa.Array, split):
    """Chunks (first row, rows, codes, offsets, owner of each segment, special
    strings per row): the texts cut at special strings."""
    data, off = string_bytes(text)
    for i, j in chunks(np.diff(off), CHUNK):
        part = data[off[i]:off[j]].tobytes()
        at = off[i:j + 1] - off[i]
        special = np.zeros(j - i, dtype=np.int64)
        owner = np.arange(j - i)
        if split is not None and split.search(part):
            pieces, owner = [], []
            for k in range(j - i):
                got = split.split(part[at[k]:at[k + 1]])
                special[k] = len(got) - 1
                pieces += got
                owner += [k] * len(got)
            part, owner = b"".join(pieces), np.array(owner)
            at = np.r_[0, np.cumsum([len(p) for p in pieces])]
        raw = np.frombuffer(part, dtype=np.uint8)
        lead = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
        codes = np.frombuffer(part.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        yield i, j - i, codes, lead[at], owner, special


def _pretokens(codes, off, classes, seed):
    """(start, end, hash) of each pre-token."""
    s = np.flatnonzero(pretoken_starts(codes, off, classes))
    e = np.r_[s[1:], len(codes)]
    return s, e, span_hashes(codes, s, e, seed).view(np.int64)


class Vocabulary:
    """A tokenizer file's pieces, special strings and split pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.source = f.read()
        spec = json.loads(self.source)
        kind = spec["pre_tokenizer"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level tokenizer")
        self.special = [t["content"] for t in spec["added_tokens"]]

    def split_pattern(self):
        parts = sorted(self.special, key=len, reverse=True)
        return "|".join(re.escape(p) for p in parts).encode() if parts else None


class Gathered:
    """Distinct pre-tokens of a task: sorted hashes with the least and largest
    check digest, frequencies and places in a list of tokens (about 90 bytes each)."""

    def __init__(self):
        self.keys, self.freq, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.low, self.high = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.tokens: list[str] = []

    def add(self, h: np.ndarray, check: np.ndarray, s: np.ndarray, e: np.ndarray, codes: np.ndarray) -> None:
        order = np.argsort(h, kind="stable")
        h, check = h[order], check[order]
        head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        keys, first, freq = h[head], order[head], np.diff(np.r_[head, len(h)])
        low, high = np.minimum.reduceat(check, head), np.maximum.reduceat(check, head)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        old, new = at[known], ~known
        self.freq[old] += freq[known]
        self.low[old] = np.minimum(self.low[old], low[known])
        self.high[old] = np.maximum(self.high[old], high[known])
        place = len(self.tokens) + np.arange(int(new.sum()))
        whole = codes.tobytes()
        self.tokens += [whole[4 * a:4 * b].decode("utf-32-le")
                        for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(), strict=True)]
        self.keys, self.freq, self.place, self.low, self.high = (
            np.insert(x, at[new], y) for x, y in ((self.keys, keys[new]), (self.freq, freq[new]), (self.place, place),
                                                   (self.low, low[new]), (self.high, high[new])))

    def batches(self, rows: int = 1 << 15):
        """Everything gathered, in parts; then empty."""
        for i in range(0, len(self.keys), rows):
            part = slice(i, i + rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.keys[part]), pa.array([self.tokens[k] for k in self.place[part].tolist()], pa.string()),
                 pa.array(self.freq[part]), pa.array(self.low[part]), pa.array(self.high[part])],
                ["h", "token", "freq", "low", "high"])
        self.__init__()


def distinct_pretokens(docs: DataFrame, vocabulary: Vocabulary, seed: int = 0) -> DataFrame:
    """h, token, freq of every distinct pre-token of the texts; ``clash`` where
    two of them have one hash (seen by independent check digests)."""
    classes = docs.sparkSession.sparkContext.broadcast(class_table(vocabulary.source))
    pattern = vocabulary.split_pattern()

    def run(batches):
        split = re.compile(pattern) if pattern else None
        seen = Gathered()
        for batch in batches:
            for _, _, codes, off, _, _ in _segments(batch.column("text"), split):
                s, e, h = _pretokens(codes, off, classes.value, seed)
                if len(h):
                    check = (span_hashes(codes, s, e, _CHECK + seed) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    seen.add(h, check, s, e, codes)
                if len(seen.keys) >= GATHER:
                    yield from seen.batches()
        yield from seen.batches()

    return docs.select("text").mapInArrow(run, "h long, token string, freq long, low int, high int").groupBy("h").agg(
        F.min("token").alias("token"), F.sum("freq").alias("freq"), (F.min("low") != F.max("high")).alias("clash"))


def piece_counts(pretokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """h, freq, pieces and clash of every pre-token, each counted once."""
    source = vocabulary.source

    def run(batches):
        # a worker has one core; the library's threads would each hold memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(source)
        library.encode_special_tokens = True
        for batch in batches:
            pieces: list[int] = []
            for i in range(0, batch.num_rows, SLICE):
                got = library.encode_batch_fast(batch.column("token").slice(i, SLICE).to_pylist(), add_special_tokens=False)
                pieces += [len(x) for x in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("freq"), pa.array(pieces, pa.int32()), batch.column("clash")],
                ["h", "freq", "pieces", "clash"])

    return pretokens.mapInArrow(run, "h long, freq long, pieces int, clash boolean")


def hot_pieces(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and pieces of the most frequent pre-tokens, ``HOT`` at most."""
    level = F.floor(F.log2(F.col("freq").cast("double"))).alias("level")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = 64, 0
    for x in sorted(sizes, reverse=True):
        if total + sizes[x] > HOT:
            break
        least, total = x, total + sizes[x]
    rows = counts.where(F.floor(F.log2(F.col("freq").cast("double"))) >= least).select("h", "pieces").toArrow()
    h, pieces = rows["h"].to_numpy(), rows["pieces"].to_numpy()
    order = np.argsort(h)
    return h[order], pieces[order]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    vocabulary = Vocabulary(path)
    docs = documents(docs, "doc_id", "text")
    bound_batches(docs.sparkSession)
    seed = 0
    while True:
        counts = cut(piece_counts(distinct_pretokens(docs, vocabulary, seed), vocabulary))
        if counts.where("clash").isEmpty():
            break
        drop(counts)
        seed += 1  # two pre-tokens had one hash: hash them anew
    sc = docs.sparkSession.sparkContext
    hot, classes = sc.broadcast(hot_pieces(counts)), sc.broadcast(class_table(vocabulary.source))
    pattern = vocabulary.split_pattern()

    def run(batches):
        split = re.compile(pattern) if pattern else None
        hot_h, hot_n = hot.value
        for batch in batches:
            sizes = np.diff(string_bytes(batch.column("text"))[1])
            for i, m, codes, off, owner, special in _segments(batch.column("text"), split):
                s, _, h = _pretokens(codes, off, classes.value, seed)
                own = owner[np.searchsorted(off, s, side="right") - 1] if len(s) else np.zeros(0, np.int64)
                if len(hot_h):
                    at = np.minimum(np.searchsorted(hot_h, h), len(hot_h) - 1)
                    known = hot_h[at] == h
                else:
                    at, known = np.zeros(len(h), np.int64), np.zeros(len(h), dtype=bool)
                done = special + np.bincount(own[known], weights=hot_n[at[known]] if len(hot_h) else None,
                                             minlength=m).astype(np.int64)
                rest, own = h[~known], own[~known]
                order = np.lexsort((rest, own))
                rest, own = rest[order], own[order]
                new = np.ones(len(rest), dtype=bool)
                new[1:] = (rest[1:] != rest[:-1]) | (own[1:] != own[:-1])
                head = np.flatnonzero(new)
                times = np.diff(np.r_[head, len(rest)])
                cuts = np.searchsorted(own[head], np.arange(m + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, m), batch.column("doc_id").slice(i, m),
                     pa.array(sizes[i:i + m]), pa.array(done),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(rest[head])),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(times))],
                    ["row", "doc_id", "n_bytes", "done", "rest", "times"])

    rows = cut(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, "row long, doc_id long, n_bytes long, done long, rest array<long>, times array<long>"))
    rare = rows.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select(
        "row", F.col("x.rest").alias("h"), F.col("x.times").alias("times"))
    more = rare.join(counts.select("h", "pieces"), "h").groupBy("row").agg(
        F.sum(F.col("times") * F.col("pieces")).alias("more"))
    n = F.col("done") + F.coalesce("more", F.lit(0))
    return rows.select("row", "doc_id", "n_bytes", "done").join(more, "row", "left").select(
        "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
