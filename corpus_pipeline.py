"""A training-corpus pipeline over ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage
reads it again from Parquet.  All but the last return the columns of documents:

1. language: documents without a letter go (no score is too low); ``run`` passes
   the predicted languages on to the result as ``lang_pred``;
2. exact: of texts equal after lower-casing A-Z, the largest doc_id stays;
3. near: of each group of near-duplicates the row with the smallest doc_id stays;
4. mix: each document as often as the target weights of its source ask for;
5. encode: piece ids of each document, and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from unilake.llm import exact_dedup, language_id, mixing, ngram_join, pieces
from unilake.llm.common import cut, drop, free_names, read_table
from unilake.llm.queries import PIECE_FILE, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, predicted: str | None = None) -> DataFrame:
    """``predicted``: the name of a further column with the predicted language."""
    return language_id.accepted(docs, predicted=predicted)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_unique(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, *carried: str) -> DataFrame:
    return pieces.encode_decode(docs, vocabulary(PIECE_FILE), carried)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: Language profiles, near-duplicate trees and piece lattices have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    name, = free_names(docs, "lang_pred")
    docs = cut(language(spark, docs, sf_dir, name))
    for _, stage in STAGES[1:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        drop(before)
    return encode(spark, docs, sf_dir, name).withColumnRenamed(name, "lang_pred")
