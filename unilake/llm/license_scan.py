"""License scans: exact phrases, and fuzzy search for short notices.

Fuzzy search: a notice of n characters may hold k = n // ``CHARS_PER_EDIT``
edits.  It is split into k + 1 seeds; by the pigeonhole principle at least one
stands unchanged in any such occurrence.  All seeds are found in one pass
(Aho-Corasick); around each the regex library's bounded-error matching decides
and gives the span and the edits.  The word that tells a notice from other
licenses' (``NAMES``) stands as a word, or run together with the notice's
neighbouring word, with few or no edits of its own.

Cases: a null text counts as empty; a text without findings has score 0 and no
labels; rows that repeat a doc_id are scanned one by one; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from unilake.llm.common import documents
from unilake.llm.textkit import ALNUM, LOWER, chunks, string_bytes, word_spans

#: Base phrases and their labels.
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl",
           ("all", "rights", "reserved"): "reserved"}
#: Short notices searched for with errors, by label.
NOTICES = {
    "apache-notice": ["licensed under the apache license, version 2.0"],
    "bsd-notice": ["redistribution and use in source and binary forms"],
    "cc-by-nc-notice": ["licensed under cc by-nc 4.0"],
    "cc-by-sa-notice": ["licensed under cc by-sa 4.0"],
    "gpl-notice": ["licensed under the gnu general public license"],
    "isc-notice": ["permission to use, copy, modify, and/or distribute this software"],
    "lgpl-notice": ["gnu lesser general public license"],
    "mit-notice": ["released under the mit license",
                   "permission is hereby granted, free of charge, to any person"],
    "mpl-notice": ["subject to the terms of the mozilla public license"],
    "reserved-notice": ["all rights reserved."],
    "unlicense-notice": ["free and unencumbered software released into the public domain"],
}
CHARS_PER_EDIT = 10
#: The word that names a notice's license, and the edits it may hold (other
#: licenses' words in its place are further away).
NAMES = {"apache-notice": ("apache", 2), "cc-by-nc-notice": ("nc", 0), "cc-by-sa-notice": ("sa", 0),
         "mit-notice": ("mit", 0), "mpl-notice": ("mozilla", 2)}
CHUNK = 1 << 20
_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def seeds(notice: str) -> list[tuple[int, str]]:
    """(offset, text) of the k + 1 parts of a notice."""
    parts = len(notice) // CHARS_PER_EDIT + 1
    cuts = [len(notice) * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def pattern(label: str, notice: str) -> str:
    """Bounded-error pattern of a notice.  Each part may hold all the edits;
    ``Finder.find`` holds their sum against the notice's bound."""
    k = len(notice) // CHARS_PER_EDIT
    name, own = NAMES.get(label, ("", 0))
    m = name and re.search(rf"\b{name}\b", notice)
    if not m:
        return f"(?b)(?:{re.escape(notice)}){{e<={k}}}"
    head, tail = notice[:m.start()], notice[m.end():]
    if own:
        name = f"(?:{name}){{e<={own}}}"
    else:
        before, after = re.findall("[a-z0-9.]+", head)[-1], re.findall("[a-z0-9.]+", tail)[0]
        name = f"(?:(?<![a-z])|(?<={re.escape(before)})){name}(?:(?![a-z])|(?={re.escape(after)}))"
    return f"(?b)(?:{re.escape(head)}){{e<={k}}}{name}(?:{re.escape(tail)}){{e<={k}}}"


class Finder:
    """All notices' seeds in one automaton, and their bounded-error patterns."""

    def __init__(self):
        import ahocorasick
        import regex

        self.notices = [(label, n) for label, ns in NOTICES.items() for n in ns]
        self.patterns = [regex.compile(pattern(label, n)) for label, n in self.notices]
        places: dict[str, list] = {}
        for i, (_, n) in enumerate(self.notices):
            for at, seed in seeds(n):
                places.setdefault(seed, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for seed, where in places.items():
            self.automaton.add_word(seed, (len(seed), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, similarity) of the notices in a lower-case text."""
        out, done = [], [-1] * len(self.notices)
        tried: set[tuple[int, int]] = set()
        for stop, (size, where) in self.automaton.iter(text):
            for i, at in where:
                label, notice = self.notices[i]
                k = len(notice) // CHARS_PER_EDIT
                begin = stop + 1 - size - at
                if begin + len(notice) // 2 < done[i] or (i, begin) in tried:
                    continue
                tried.add((i, begin))
                m = self.patterns[i].search(text, max(0, begin - k, done[i]), begin + len(notice) + 2 * k)
                if m and sum(m.fuzzy_counts) <= k:
                    out.append((m.start(), m.end(), label, 1 - sum(m.fuzzy_counts) / len(notice)))
                    done[i] = m.end()
        return out


def base_places(text: str) -> list[tuple[int, str]]:
    """(word number, label) of every place where a phrase's words stand."""
    if not any(all(w in text for w in p) for p in PHRASES):
        return []
    words = _WORD.findall(text)
    out = []
    for i, w in enumerate(words):
        for p, label in PHRASES.items():
            if w == p[0] and tuple(words[i:i + len(p)]) == p:
                out.append((i, label))
    return out


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<start: int, end: int, label: string, similarity: double>>")


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, base phrases, labels, score and the spans
    (code points, end exclusive) of the fuzzy matches."""
    def run(batches):
        finder = Finder()
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")[:8]] + ["spans"]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()),
                                   ("similarity", pa.float64())]))
        for batch in batches:
            data, off = string_bytes(batch.column("text"))
            for i, j in chunks(np.diff(off), CHUNK):
                part, at = LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i]
                starts, _ = word_spans(part, at, ALNUM)
                n_words = np.diff(np.searchsorted(starts, at))
                raw, cols = part.tobytes(), [[] for _ in range(7)]
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    text = raw[a:b].decode("utf-8")
                    base, fuzzy = base_places(text), sorted(finder.find(text))
                    own = {label for _, label in base}
                    row = (len(base), base[0][0] if base else None, base[-1][0] if base else None,
                           ",".join(sorted(own)), ",".join(sorted(own | {x[2] for x in fuzzy})),
                           1.0 if base else round(max((x[3] for x in fuzzy), default=0.0), 6), fuzzy)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                spans = [[{"start": s, "end": e, "label": x, "similarity": y} for s, e, x, y in f] for f in cols[6]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n_words, pa.int64()),
                     *[pa.array(c, t) for c, t in zip(cols[:6], [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()], strict=True)],
                     pa.array(spans, span)], names)

    return documents(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
