"""Exact dedup by a tree-merge of digest runs (DataFrame operations only).

Every scan partition forms a run of (digest, largest identifier, count).  In
each round, groups of ``FAN`` neighbouring runs exchange their entries by
(merged run, digest) and merge them, until one run is left; a group's answer
then travels back down the same tree.  A digest held by a third of all rows is
one entry per run from the first round on, so it never meets in one task.

An entry's key is the SHA-256 of the normalised text, verified at every level
by its byte length and an independent 128-bit digest: entries that differ in
any of them are not merged.

Cases: a null text counts as empty; texts are equal after lower-casing A-Z
only; of rows that repeat a doc_id with the same text one row is kept; a null
doc_id sorts below all others; an empty table gives an empty result; extra
columns are ignored (``keep_unique`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.llm.common import cut, documents, free_names, lower_ascii, settled, sift

#: Runs merged into one per round.
FAN = 8
_KEY = ["sha", "size", "check"]


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest key and run of every row."""
    norm = lower_ascii(F.coalesce("text", F.lit("")))
    return documents(docs, "doc_id", "text").select("doc_id", norm.alias("norm")).select(
        "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.octet_length("norm").cast("long").alias("size"), F.unhex(F.md5("norm")).alias("check"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("at"))


def groups(rows: DataFrame) -> DataFrame:
    """``rows`` with ``top`` (doc_id, at of the row that stays) and ``members``."""
    top = F.max(F.struct("doc_id", "at"))
    level = cut(rows.groupBy("run", *_KEY).agg(top.alias("top"), F.count(F.lit(1)).alias("members")))
    levels, runs = [level], (rows.agg(F.max("run")).first()[0] or 0) + 1
    while runs > 1:
        runs = -(-runs // FAN)
        level = cut(level.groupBy(F.floor(F.col("run") / FAN).cast("int").alias("run"), *_KEY)
                    .agg(F.max("top").alias("top"), F.sum("members").alias("members")))
        levels.append(level)
    answer = levels.pop()
    for below in reversed(levels):
        down = below.select("run", *_KEY, F.floor(F.col("run") / FAN).cast("int").alias("up"))
        answer = down.join(answer.withColumnRenamed("run", "up"), ["up", *_KEY]).drop("up")
    return rows.join(answer, ["run", *_KEY])


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    found = groups(cut(digests(docs)))
    return found.select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), F.col("members").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("at") == F.col("top.at"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def _beaten(docs: DataFrame, own: str, text: str, one: str) -> DataFrame:
    """(``own``, ``text``, ``one``): doc_id and digest of the rows that go; ``one``:
    a row with both stays, as they repeat."""
    rows = cut(digests(docs))
    gone = groups(rows).where("not (doc_id <=> top.doc_id and at = top.at)")
    gone = cut(gone.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("copies")))
    # a doc_id may repeat: of its rows with one text, as many go as were beaten
    held = rows.groupBy(F.col("doc_id").alias(own), F.col("sha").alias(text)).agg(F.count(F.lit(1)).alias("held"))
    return gone.join(held, F.col(own).eqNullSafe(F.col("doc_id")) & (F.col(text) == F.col("sha"))).select(
        own, text, (F.col("held") > F.col("copies")).alias(one))


def keep_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stays, with all their columns.

    Texts are moved only of rows whose doc_id may be that of a row that goes."""
    own, text, one = free_names(docs, "_id", "_sha", "_one")
    gone = settled(lambda: _beaten(docs, own, text, one))
    if gone.isEmpty():
        return docs
    sha = F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256))
    same = F.col(own).eqNullSafe(F.col("doc_id")) & (F.col(text) == sha)
    clear, rest = sift(docs, "doc_id", gone.select(own))
    out = clear.union(rest.join(gone, same, "left_anti"))
    some = gone.where(one)
    if some.isEmpty():
        return out
    return out.union(rest.join(some, same).dropDuplicates([own, text]).select(docs.columns))
