"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unilake.llm import (conversations, exact_dedup, hard_negatives, language_id, license_scan, line_dedup, mixing, ngram_join, pieces,
                         secrets, sharding, token_count, vector_dedup)
from unilake.llm.common import read_table

#: Vocabulary files, by the name that ``public_tokenizers.path`` takes.
BPE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(read_table(spark, sf_dir, "documents"), vocabulary(PIECE_FILE))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary(BPE_FILE))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(read_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec, label = F.col("vec_id"), F.col("label")
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), vec % 100 == 0,
                               F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damaged(turns), turns)


QUERIES = {f.__name__: f for f in (
    op1_vector_near_dedup, op2_ngram_jaccard_join, op3_line_dedup, op4_sentencepiece, op5_source_mixing, op6_token_count,
    op7_secret_scan, op8_exact_dedup, op9_language_id, op10_license_scan,
    op11_hard_negatives, op12_sharding, op13_conversation_repair)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

#: What SQL can express: the results' meaning, by plain comparison of all rows.
ORACLE: dict[str, str] = {
    "op1_vector_near_dedup": """
        with recursive v as (
            select vec_id, label, embedding::double[] as e from embeddings
            where label is not null and embedding is not null),
        links as (
            select a.vec_id as x, b.vec_id as y from v a join v b
            on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
               and list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(x, y) as (
            select vec_id, vec_id from embeddings
            union select r.x, l.y from reach r join links l on l.x = r.y)
        select r.x as vec_id, coalesce(max(n.n), 0) as n_links, min(r.y) as component_id,
               r.x = min(r.y) as kept
        from reach r left join (select x, count(*) as n from links group by x) n on n.x = r.x
        group by r.x""",
    "op2_ngram_jaccard_join": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as words from documents),
        s as (
            select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
            from w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as t(i) where len(words) > 0),
        n as (select doc_id, count(*) as n from s group by doc_id),
        shared as (
            select a.doc_id as x, b.doc_id as y, count(*) as k
            from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
        links as (
            select x, y from shared join n a on a.doc_id = x join n b on b.doc_id = y
            where 100 * k >= 75 * (a.n + b.n - k)),
        reach(x, y) as (
            select doc_id, doc_id from documents
            union select r.x, l.y from reach r join links l on l.x = r.y)
        select x as doc_id, coalesce(max(n.n), 0) as n_shingles, min(y) as component_id
        from reach left join n on n.doc_id = x group by x""",
    "op8_exact_dedup": f"""
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
        from (select doc_id, {_LOWERED} as t from documents)
        window same as (partition by t)""",
    "op11_hard_negatives": """
        with v as (
            select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
                   [floor(256 * x::double) for x in embedding] as e
            from embeddings
            where vec_id is not null and label is not null and len(embedding) > 0
              and len([x for x in embedding if x is null or not isfinite(256 * x::double)]) = 0),
        s as (
            select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id,
                   list_dot_product(a.e, b.e)::bigint as score
            from v a join v b on a.vec_id % 100 = 0 and len(a.e) = len(b.e) and a.vec_id <> b.vec_id),
        p as (
            select anchor_id, id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
        select anchor_id, positive_id, row_number() over first::int as rank, id as negative_id,
               positive_score, score as negative_score
        from p join s using (anchor_id)
        where not same and 100 * score between 30 * positive_score and 90 * positive_score
        window first as (partition by anchor_id, positive_id order by score desc, id)
        qualify rank <= 10""",
}
