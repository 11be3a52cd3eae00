"""Secret scans: patterns plus sliding-window entropy (DataFrame operations only).

Base kinds, each leftmost and non-overlapping: ``assign`` (a keyword, a sign
and a value), ``access`` (cloud access keys) and ``hex`` runs.  The method adds
``entropy``: over each candidate string (a run of key characters) a window
of ``WINDOW`` characters slides; its Shannon entropy is kept by incremental
counts, adding the entering and removing the leaving character.  A candidate is
reported from its first to its last window at or above the threshold of its
character class.  An allow-list suppresses what is known not to be a secret:
placeholder words cut a run, and what stands before and after them are
candidates of their own; whole candidates that are UUIDs, plain words or numbers
are left out.  Entropies are computed by the tasks that read the candidates.

Positions come from the matches themselves: a pattern is matched together with
the text before it, so start = the lengths of all pieces before.

Cases: a null text counts as empty; a text without findings has counts 0 and
empty spans; rows that repeat a doc_id are scanned one by one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.llm.common import cut, documents

KINDS = ("assign", "access", "hex", "entropy")
_KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
#: kind -> (quick test, pattern whose last group is the value, least length of the value)
PATTERNS = {
    "assign": (_KEYWORD + r"""["']?\x20*[:=]""",
               _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": (r"AKIA[A-Z0-9]{16}", r"(AKIA[A-Z0-9]+)", 20),
    # a run is tried from its first character only
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24}", r"((?<![0-9a-f])[0-9a-f]{24,})", 24),
    "entropy": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20}",
                r"((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,})", 20),
}
WINDOW = 20
#: Least entropy in bits of a window, by class of the candidate's characters.
HEX_BITS, ALNUM_BITS, BASE64_BITS = 3.0, 3.6, 3.7
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Words of placeholders, which cut a run.
PLACEHOLDER = r"(?i:example|placeholder|changeme|your[_-]|x{6}|0{8}|1234567)"
#: Candidates that are no secrets: UUIDs, words or numbers joined by signs, file
#: paths of plain words.
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         r"^[A-Za-z_=/+-]*$", r"^[0-9_=/+-]*$", r"^([A-Za-z]+|[0-9]{1,4})([-_/=+]([A-Za-z]+|[0-9]{1,4}))*$")


def _pieces(text: Column, kind: str) -> Column:
    """array<struct<kind, gap, span, value, text>> of a kind's matches, in order.

    ``gap``: characters before the match since the last one; ``value``: length
    of the value; ``text``: the match (entropy candidates only)."""
    quick, pattern, _ = PATTERNS[kind]
    # the end of the text counts as a match too, or the rest would be searched
    # from each of its positions; it has span 0 and is left out
    both = F.lit(rf"(?s)(.*?)({pattern}|\z)")
    get = lambda i: F.regexp_extract_all(text, both, F.lit(i))
    lengths = lambda a: F.transform(a, F.length)
    rows = F.arrays_zip(lengths(get(1)).alias("gap"), lengths(get(2)).alias("span"),
                        lengths(get(3)).alias("value"),
                        (get(2) if kind == "entropy" else F.transform(get(1), lambda x: F.lit(""))).alias("text"))
    rows = F.transform(rows, lambda r: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), r["gap"].alias("gap"), r["span"].alias("span"),
        r["value"].alias("value"), r["text"].alias("text")))
    test = F.rlike(text, F.lit(quick))
    if kind == "assign":  # no sign, no assignment
        test = (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & test
    return F.when(test, rows)


def _candidates(text: Column) -> Column:
    """array<struct<at, text>>: a run's parts between placeholder words that a
    window fits into, with their offsets."""
    both = F.lit(rf"(?s)(.*?)({PLACEHOLDER}|\z)")
    cut_ = F.arrays_zip(F.regexp_extract_all(text, both, F.lit(1)).alias("part"),
                        F.transform(F.regexp_extract_all(text, both, F.lit(2)), F.length).alias("word"))
    none = F.array().cast("array<struct<at:int,text:string>>")
    parts = F.aggregate(cut_, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, p: F.struct(
        (a["at"] + F.length(p["part"]) + p["word"]).alias("at"),
        F.when(F.length(p["part"]) >= WINDOW, F.concat(a["out"], F.array(F.struct(
            a["at"].alias("at"), p["part"].alias("text"))))).otherwise(a["out"]).alias("out")), lambda a: a["out"])
    plain = F.array(F.struct(F.lit(0).alias("at"), text.alias("text")))
    return F.when(F.rlike(text, F.lit(PLACEHOLDER)), parts).otherwise(plain)


def _entropy_spans(found: DataFrame) -> DataFrame:
    """``found`` (text, ...) with ``hot``: the ends of the first and last window of
    the candidate that reaches its class's entropy (null for allowed ones).

    S, the sum of c * log2(c) over the window's characters, changes by
    f(c+1) - f(c) for the character that enters and f(c-1) - f(c) for the one
    that leaves; a window's entropy is log2(WINDOW) - S / WINDOW.  Step i reads
    the window that ended before character i.
    """
    bits = F.when(F.rlike("text", F.lit("^([0-9a-f]+|[0-9A-F]+)$")), F.lit(HEX_BITS)).when(
        F.rlike("text", F.lit("^[A-Za-z0-9]+$")), F.lit(ALNUM_BITS)).otherwise(F.lit(BASE64_BITS))
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | F.rlike("text", F.lit(pattern))
    weights = ", ".join("0D" if c < 2 else f"{c}D * log2({c}D)" for c in range(WINDOW + 2))
    found = found.withColumn("most", F.lit(WINDOW) * (F.log2(F.lit(float(WINDOW))) - bits) + F.lit(1e-9)) \
        .withColumn("n", F.length("text")).withColumn("w", F.expr(f"array({weights})")) \
        .withColumn("codes", F.expr(f"transform(split(text, ''), c -> locate(c, '{ALPHABET}') - 1)"))
    x, y = "codes[least(i, n - 1)]", f"codes[greatest(i - {WINDOW}, 0)]"
    seen = f"i >= {WINDOW} and a.s <= most"
    at = F.expr(f"""
        aggregate(sequence(0, n),
          named_struct('c', array_repeat(0, {len(ALPHABET)}), 's', 0D, 'first', 0, 'last', 0),
          (a, i) -> named_struct(
            'c', transform(a.c, (v, k) -> v + if(i < n and k = {x}, 1, 0) - if(i >= {WINDOW} and k = {y}, 1, 0)),
            's', a.s + if(i < n and i >= {WINDOW} and {x} = {y}, 0D,
                if(i < n, w[a.c[{x}] + 1] - w[a.c[{x}]], 0D)
                + if(i >= {WINDOW}, w[a.c[{y}] - 1] - w[a.c[{y}]], 0D)),
            'first', if(a.first = 0 and {seen}, i, a.first),
            'last', if({seen}, i, a.last)))""")
    return found.withColumn("hot", F.when(~allowed, at)).drop("codes", "w", "most", "n")


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id and every finding: kind, start, end (code points, end exclusive)."""
    rows, found = _scan(docs)
    return rows.select("row", "doc_id").join(found, "row")


def _scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    text = documents(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = cut(text.select("row", "doc_id", *[_pieces(F.col("text"), k).alias(k) for k in KINDS]))
    hits = None
    for k in KINDS:
        one = rows.select("row", F.posexplode(k).alias("pos", "m")).select("row", "pos", "m.*")
        one = one.withColumn("move", F.col("gap") + F.col("span"))
        if k == "entropy":
            # one row per candidate; only the first moves on in the text
            one = one.select("*", F.posexplode_outer(_candidates(F.col("text"))).alias("part", "c")).select(
                "row", "kind", "pos", F.coalesce("part", F.lit(0)).alias("part"), "span", "value",
                F.when(F.coalesce("part", F.lit(0)) == 0, F.col("move")).otherwise(0).alias("move"),
                F.col("c.at").alias("at"), F.col("c.text").alias("text"))
            one = _entropy_spans(one).withColumn("at", F.when(F.col("hot.last") > 0, F.col("at")))
            one = one.select("row", "kind", "pos", "part", "span", "value", "move",
                             (F.col("at") + F.col("hot.first") - WINDOW).alias("a"), (F.col("at") + F.col("hot.last")).alias("b"))
        else:
            one = one.select("row", "kind", "pos", F.lit(0).alias("part"), "span", "value", "move",
                             F.lit(0).alias("a"), F.col("span").alias("b"))
        hits = one if hits is None else hits.union(one)
    before = W.partitionBy("row", "kind").orderBy("pos", "part").rowsBetween(W.unboundedPreceding, 0)
    start = F.sum("move").over(before) - F.col("span")
    least = F.element_at(F.array(*[F.lit(PATTERNS[k][2]) for k in KINDS]), F.col("kind") + 1)
    hits = hits.withColumn("start", start).where((F.col("value") >= least) & F.col("a").isNotNull())
    return rows, hits.select("row", "kind", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("end"))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans of every row."""
    rows, found = _scan(docs)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("said"))
    is_base = F.col("kind") < KINDS.index("entropy")
    texts = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda s: s["said"]), ",")
    per = found.groupBy("row").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        texts(F.collect_list(F.when(is_base, span))).alias("base"), texts(F.collect_list(span)).alias("spans"))
    return rows.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
