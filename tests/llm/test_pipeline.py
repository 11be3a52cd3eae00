"""The pipeline against its stages' brute-force versions."""

import math
import re
import uuid
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from unilake.llm import common, exact_dedup, language_id, ngram_join
from unilake.session import path_exists
from tests.llm.conftest import SF
from tests.llm.test_native import lower, targets
from tests.llm.test_ngram_join import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    frame, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.cut(stage(spark, frame, SF))
        assert frame.columns == COLUMNS
        seen[name] = frame.collect()
        assert all(r == rows[r["doc_id"]] for r in seen[name])
    ids = {k: Counter(r["doc_id"] for r in v) for k, v in seen.items()}
    assert set(ids["language"]) == {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    top = {}
    for i in ids["language"]:
        top[lower(rows[i]["text"])] = max(i, top.get(lower(rows[i]["text"]), i))
    assert ids["exact"] == Counter(top.values())
    groups = brute([(i, rows[i]["text"]) for i in ids["exact"]])
    assert ids["near"] == Counter(c for i, (_, c) in groups.items() if i == c)
    size = lambda i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i]["text"]))
    total, took = Counter(), Counter()
    for i in ids["near"]:
        total[rows[i]["source"]] += size(i)
    for i, n in ids["mix"].items():
        assert n <= 2 and i in ids["near"]
        took[rows[i]["source"]] += n * size(i)
    want = targets(total)
    for source, target in want.items():   # whole copies: each document's rounding is up or down by chance
        spread = math.sqrt(sum(size(i) ** 2 for i in ids["near"] if rows[i]["source"] == source)) / 2
        assert abs(took[source] - target) <= 4 * spread + 0.02 * target
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in out) == ids["mix"]
    assert all(r["decoded"] == rows[r["doc_id"]]["text"] and len(r["ids"]) == r["n_ids"] for r in out)


def odd_documents():
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    near = "one of the texts that come back with a word or two changed here and there at the end"
    return [(1, None, None, None), (2, "", "en", "a"), (3, "12 34 !", "en", "b"), (None, near, "en", "a"),
            (None, near + " x", "en", "a"), (4, near + " y", None, None), (5, near.upper(), "en", "c"), (6, long, "en", "a"),
            (7, "repeated id", "en", "b"), (7, "another text under it", "de", "b"), (8, "same row", "en", "b"),
            (8, "same row", "en", "b"), (None, "alone without id", None, None), (9, "é\n中文\t😀", "zh", "é")]


@pytest.mark.parametrize("extra", [(), ("node", "_id", "_sha", "_one", "_copies", "_copy", "group", "first", "lang_pred", "score",
                                       "row", "h", "ids")])
def test_odd_rows_pass_every_stage(spark, make_docs, extra):
    docs = make_docs(odd_documents()).repartition(3)
    for c in extra:
        docs = docs.withColumn(c, F.lit(c))
    frame, left = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.cut(stage(spark, frame, ""))
        assert frame.columns == docs.columns
        left[name] = Counter((r["doc_id"], r["text"]) for r in frame.collect())
        assert all(r[c] == c for r in frame.collect() for c in extra)
    rows = odd_documents()
    lettered = Counter((i, t) for i, t, *_ in rows if any(c.isalpha() for c in t or ""))
    assert left["language"] == lettered
    top = {}
    for i, t in lettered:   # of equal texts the largest doc_id, null below all
        top[lower(t)] = max((i is not None, i or 0, t), top.get(lower(t), (False, 0, t)))
    assert left["exact"] == Counter((i if known else None, t) for known, i, t in top.values())
    near = [r for r in left["near"] if r[1].lower().startswith("one of the texts")]
    assert len(near) == 1 and near[0][0] == 4   # the smallest id of the group, not a row without one
    assert all(left["near"][r] == 1 for r in left["exact"] if not r[1].lower().startswith("one of the texts"))
    assert all(n <= 2 and r in left["near"] for r, n in left["mix"].items())
    out = corpus_pipeline.encode(spark, frame, "").collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in out) == left["mix"]


def test_predicted_languages_reach_the_result(spark, make_docs, tmp_path):
    rows = [(i, f"the cat and the dog walk over the hill with number word{i}", "en", "a") for i in range(8)] + \
        [(i, f"der hund und die katze laufen durch den wald nach haus wort{i}", "de", "b") for i in range(10, 18)] + \
        [(20, "the dog and the cat are over there", None, "a"), (21, "die katze und der hund", None, "b"), (22, "12 34", "en", "a")]
    docs = make_docs(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(
        docs.select("doc_id", "text"), *language_id.learn(docs.select("text", "lang"))).collect()}
    assert want[20] == "en" and want[21] == "de"
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) > 0 and all(r["lang_pred"] == want[r["doc_id"]] != "und" for r in out)


def test_stages_leave_one_table_and_move_few_texts(spark, make_docs, tmp_path, monkeypatch):
    """Whatever a stage writes on its way goes; rows that stay for sure meet no shuffle."""
    left = lambda: len(list(tmp_path.glob("llm-*")))
    monkeypatch.setattr(common, "fresh_dir", lambda _, purpose: f"{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    monkeypatch.setattr(common, "SIFT_BITS", 1 << 15)
    texts = [" ".join(f"t{i}w{k}" for k in range(9)) for i in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    extra = [(None, texts[0]), (-(1 << 63), texts[1] + " end"), (None, texts[2] + " end"), (None, texts[3] + " tail"),
             (300, texts[4] + " end"), (301, texts[5].upper()), (301, texts[5]), (302, "rep"), (302, "rep")]
    docs = make_docs(rows + extra).repartition(5)
    for stage, gone in ((exact_dedup.keep_unique, {(None, texts[0]), (5, texts[5]), (302, "rep")}),
                        (ngram_join.keep_one, {(None, texts[0]), (None, texts[2] + " end"), (None, texts[3] + " tail"),
                                               (1, texts[1]), (300, texts[4] + " end"), (301, texts[5].upper()),
                                               (301, texts[5])})):
        before = left()
        out = stage(docs)
        assert left() == before + 1
        want = Counter(rows + extra)
        got = Counter((r["doc_id"], r["text"]) for r in out.collect())
        lost = want - got
        assert not got - want and sum(lost.values()) == len(gone) + (stage is exact_dedup.keep_unique)
        if stage is ngram_join.keep_one:
            assert set(lost) == gone
        else:   # of the two rows 301, either text
            assert set(lost) - {(301, texts[5].upper()), (301, texts[5])} == gone
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftSemi" in plan   # only rows of the filter come to the exact join


def test_sift(spark):
    ids = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("bits"))
    for keys in (ids.where("doc_id % 50 = 0"), ids.where("doc_id is null"), ids.where("false")):
        clear, rest = common.sift(ids, "doc_id", keys.select("doc_id"))
        assert clear.columns == rest.columns == ids.columns
        a, b = ([r["doc_id"] for r in x.collect()] for x in (clear, rest))
        assert Counter(a + b) == Counter([None, *range(1, 5000)])
        wanted = {r["doc_id"] for r in keys.collect()}
        assert wanted <= set(b) and len(b) <= len(wanted) + 5


def test_run_keeps_no_table_of_an_earlier_stage(spark, make_docs, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(corpus_pipeline, "cut", lambda df: made.append(common.cut(df)) or made[-1])
    make_docs([(1, "a few words here", "en", "a"), (2, "other words", "en", "a")]).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert [path_exists(spark, t._unilake_path) for t in made] == [False] * (len(made) - 1) + [True]
    assert out.count() > 0


def test_empty_table_passes_every_stage(spark, make_docs):
    frame = make_docs([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.cut(stage(spark, frame, ""))
        assert frame.columns == COLUMNS and frame.count() == 0
    assert corpus_pipeline.encode(spark, frame, "").collect() == []


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = [k.split("_")[0] for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in entry.queries()
