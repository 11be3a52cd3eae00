"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A
letter trigram is bound from its letters' vectors, each permuted (rolled) by
its position and multiplied; a document bundles (sums) its trigrams' vectors,
and a language's prototype bundles its training documents, each weighted to
its length.  A document takes the language whose prototype has the largest
cosine with its own vector; that cosine, cut to 0..1, is the score.

Letters are compared in lower case; a run of other characters is one space.
All training documents are read; per task only one sum per language and
trigram leaves, so a hot language is no burden.

Cases: a null text, or one without a letter, is ``und`` with score 0; ties go
to the first language in code-point order; a null lang teaches nothing;
without any training document all predictions are ``und``; a null doc_id
counts as the text ``null`` for the fold; an empty table gives an empty
result; extra columns are ignored (``accepted`` returns them unchanged).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm.common import documents
from unilake.llm.textkit import U, chunks, mix64, string_bytes

#: Length of the vectors.
DIMENSIONS = 512
#: Documents whose vectors are made at a time, and bytes of their texts.
ROWS, CHUNK = 256, 1 << 20
#: ``accepted`` keeps documents that score at least this much.  Very short
#: texts score low whatever their language, so by default only texts without
#: a recognisable letter go.
LEAST_SCORE = 0.0
_SPACE = 0x20
#: Groups that the tasks' vectors of one language are added in first.
PARTS = 256


def letter_table() -> np.ndarray:
    """Code point -> lower-case letter's code point, or 0 for no letter."""
    out = np.zeros(0x110000, dtype=np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """One +1/-1 vector per code point, the same in every task."""
    words = mix64(codes.astype(U)[:, None] * U(DIMENSIONS) + np.arange(DIMENSIONS // 64, dtype=U) + U(1))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def trigrams(data: np.ndarray, off: np.ndarray, letters: np.ndarray):
    """(owner, trigram) of each letter trigram, trigrams numbered densely, and
    the three letters of each number."""
    lens = np.diff(off)
    text = data.tobytes().decode("utf-8", "replace")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lead = (data & 0xC0) != 0x80
    owner = np.repeat(np.arange(len(lens)), lens)[lead]
    if len(owner) != len(codes):  # malformed bytes: decode each text by itself
        parts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode(
            "utf-32-le", "surrogatepass"), dtype=np.uint32) for a, b in zip(off[:-1], off[1:], strict=True)]
        codes = np.concatenate(parts) if parts else codes
        owner = np.repeat(np.arange(len(lens)), [len(p) for p in parts])
    x = letters[codes]
    has = np.bincount(owner[x > 0], minlength=len(lens)) > 0
    # a space before and after each text; runs of non-letters become one space
    ends = np.searchsorted(owner, np.arange(len(lens) + 1))
    # (where two texts meet, the end of the first comes before the start of the second)
    at = np.r_[ends[1:], ends[:-1]]
    x = np.insert(x, at, 0)
    owner = np.insert(owner, at, np.tile(np.arange(len(lens)), 2))
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] > 0) | (x[:-1] > 0) | (owner[1:] != owner[:-1])
    x, owner = x[keep], owner[keep]
    x = np.where(x == 0, _SPACE, x)
    ok = (owner[2:] == owner[:-2]) if len(x) > 2 else np.zeros(0, bool)
    used, dense = np.unique(x, return_inverse=True)
    k = len(used)
    gram = ((dense[:-2] * k + dense[1:-1]) * k + dense[2:])[ok] if len(x) > 2 else np.zeros(0, np.int64)
    if k <= 160:
        present = np.flatnonzero(np.bincount(gram, minlength=k ** 3))
        number = np.zeros(k ** 3, dtype=np.int64)
        number[present] = np.arange(len(present))
        gram = number[gram]
    else:
        present, gram = np.unique(gram, return_inverse=True)
    three = np.stack([used[present // (k * k)], used[present // k % k], used[present % k]], axis=1)
    return (owner[2:][ok] if len(x) > 2 else owner[:0]), gram, three, has


def gram_vectors(three: np.ndarray) -> np.ndarray:
    codes, at = np.unique(three, return_inverse=True)
    v, at = letter_vectors(codes), at.reshape(three.shape)
    return np.roll(v, 2, axis=1)[at[:, 0]] * np.roll(v, 1, axis=1)[at[:, 1]] * v[at[:, 2]]


def frequencies(owner, gram, n_rows, n_grams):
    return np.bincount(owner * n_grams + gram, minlength=n_rows * n_grams) \
        .reshape(n_rows, n_grams).astype(np.float32)


def _batches(batch):
    data, off = string_bytes(batch.column("text"))
    for i, j in chunks(np.diff(off), CHUNK, ROWS):
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their prototypes (one row each).
    ``docs``: text, lang.  What reaches the driver is one vector a language."""
    letters = docs.sparkSession.sparkContext.broadcast(letter_table())

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for i, j, data, off in _batches(batch):
                owner, gram, three, has = trigrams(data, off, letters.value)
                if not len(gram):
                    continue
                f = frequencies(owner, gram, j - i, len(three))
                f /= np.maximum(f.sum(axis=1, keepdims=True), 1)
                f[~has] = 0
                own = langs[i:j]
                sums = np.stack([f[own == x].sum(axis=0) for x in dict.fromkeys(own)])
                for x, v in zip(dict.fromkeys(own), sums @ gram_vectors(three), strict=True):
                    total[x] = total.get(x, 0) + v.astype(np.float64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                ["lang", "vector"])

    def add(pdf):
        rows = np.stack([np.frombuffer(v, dtype=np.float64) for v in pdf["vector"]])
        return pd.DataFrame({"lang": pdf["lang"][:1], "vector": [rows.sum(axis=0).tobytes()]})

    # a hot language has a vector from every task: they are added in two steps
    sums = docs.where("lang is not null").select("text", "lang").mapInArrow(run, "lang string, vector binary")
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part")
    some = sums.select("lang", "vector", part).groupBy("lang", "part").applyInPandas(add, "lang string, vector binary")
    rows = some.groupBy("lang").applyInPandas(add, "lang string, vector binary").collect()
    # sums of many tasks differ in their last bits with the order of tasks
    found = {r["lang"]: np.round(np.frombuffer(bytes(r["vector"]), dtype=np.float64), 6) for r in rows}
    found = {k: v / np.linalg.norm(v) for k, v in sorted(found.items()) if np.linalg.norm(v) > 0}
    return list(found), np.array(list(found.values())).reshape(len(found), DIMENSIONS)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray,
            keep_text: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score, and without the text unless it is
    to be kept; only the text is looked at."""
    sc = docs.sparkSession.sparkContext
    letters, protos = sc.broadcast(letter_table()), sc.broadcast(prototypes.astype(np.float32))
    carried = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches):
        for batch in batches:
            for i, j, data, off in _batches(batch):
                owner, gram, three, has = trigrams(data, off, letters.value)
                names, scores = np.full(j - i, "und", dtype=object), np.zeros(j - i)
                if has.any() and len(languages):
                    v = frequencies(owner, gram, j - i, len(three)) @ gram_vectors(three)
                    cos = v @ protos.value.T / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
                    best = cos.argmax(axis=1)
                    names[has] = np.array(languages, dtype=object)[best[has]]
                    scores[has] = np.clip(cos[np.arange(j - i), best][has], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in carried],
                     pa.array(names, pa.string()), pa.array(np.round(scores, 6))],
                    [*carried, "lang_pred", "score"])

    kinds = "".join(f"`{c}` {t}, " for c, t in docs.select(carried).dtypes)
    return docs.mapInArrow(run, f"{kinds}lang_pred string, score double")


def _fold(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), F.lit(4))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learnt on the folds not held out."""
    rows = documents(docs, "doc_id", "text", "lang").withColumn("held_out", _fold(F.col("doc_id")) == 2)
    model = learn(rows.where("not held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), *model)


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE, predicted: str | None = None) -> DataFrame:
    """The documents whose language is recognised, with all their columns.

    Rejected: texts without a letter, and texts that score under ``least_score``.
    Scores are 0 at least, so the default rejects letterless texts only.
    ``predicted``: the name of a further column with the predicted language."""
    model = learn(documents(docs, "text", "lang"))
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]  # free of clashes
    out = predict(docs.toDF(*names), *model, keep_text=True).where((F.col("lang_pred") != "und") & (F.col("score") >= least_score))
    if predicted is None:
        return out.select(names).toDF(*docs.columns)
    return out.select(*names, "lang_pred").toDF(*docs.columns, predicted)
