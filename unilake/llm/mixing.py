"""Mixing sources to target weights by Sainte-Lague apportionment.

Only DataFrame operations.  Sizes are words.  Sources in code-point order
(null last) weigh 3, 1, 2, repeating; together they get ``SHARE`` of all words,
none more than ``CAP`` times its own.  The mix is cut into blocks of equal
size: the blocks go to sources, and each source's blocks to its shards, by
highest quotients weight / (2k - 1).  A shard that gets more blocks than it
has takes every block once (or twice) and the rest by a seeded permutation.
What a source's blocks leave of its target, or hold beyond it, is settled in
words: the permutation's next block is taken in part, so that sources smaller
than a few blocks meet their targets too.

A source is split into shards of bounded size by a hash of the identifier, so
a source with a third of all rows is many shards.  Ranks are global range
sorts with one offset per partition, never a one-task window.

Cases: a null text has size 0 and takes nothing; null is a source of its own;
rows that repeat a doc_id are separate documents; with no words at all, targets
and takings are 0; an empty table gives an empty result; extra columns are
ignored (``mixed`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.llm.common import cut, documents, free_names, ranked

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
#: Words of a block: the mix has about a million blocks, of at most 256 words.
MOST_BLOCK_WORDS, LEAST_BLOCKS = 256, 1 << 20
#: Words of a shard, about.
SHARD_WORDS = 1 << 20
#: Multipliers of the seeded permutations: primes above any shard's blocks.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)


def document_sizes(docs: DataFrame) -> DataFrame:
    return documents(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """party, source, source_size, target of every source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = ranked(per, F.col("source").asc_nulls_last(), name="party")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("party") % len(WEIGHTS)).cast("int") + 1)
    per = cut(per.withColumn("weight", weight))
    whole = SHARE * (per.agg(F.sum("source_size")).first()[0] or 0)
    rest, weights = whole, per.agg(F.sum("weight")).first()[0] or 1
    full = F.lit(False)
    while True:  # what a full source can't take goes to the others by weight
        target = F.col("weight") * F.lit(float(rest)) / F.lit(float(weights))
        full = full | (target > CAP * F.col("source_size"))
        capped, open_weights = per.agg(
            F.coalesce(F.sum(F.when(full, CAP * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if (whole - capped, open_weights) == (rest, weights) or not open_weights:
            break
        rest, weights = whole - capped, open_weights
    return cut(per.select("party", "source", "source_size", F.when(
        full, (CAP * F.col("source_size")).cast("double")).otherwise(target).alias("target")))


def apportion(parties: DataFrame) -> DataFrame:
    """Seats per party by Sainte-Lague.  ``parties``: pool, party, weight, and
    the pool's seats, the same on each of its rows; returns (party, seats).

    Rounding each quota gives almost all seats; the few left are the highest
    quotients among a handful of candidates per party, so the work follows the
    number of parties, not of seats.
    """
    total = parties.groupBy("pool").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n"))
    p = parties.join(total, "pool").where("weight > 0 and seats > 0")
    near = F.floor(F.col("weight") * F.col("seats") / F.col("total") + F.lit(0.5))
    width = F.ceil(F.col("n") * F.col("weight") / F.col("total")) + 1
    p = cut(p.select("pool", "party", "weight", "seats", near.alias("near"), width.alias("width"),
                     F.greatest(F.lit(0), near - width).alias("base")))
    left = p.groupBy("pool").agg((F.first("seats") - F.sum("base")).alias("left"))
    quotient = F.col("weight") / (2 * F.col("k") - 1)
    tries = p.select("pool", "party", "weight", F.explode(
        F.sequence(F.col("base") + 1, F.col("near") + F.col("width"))).alias("k")).select(
            "pool", "party", quotient.alias("quotient"))
    order = ranked(tries, F.col("pool"), F.col("quotient").desc(), F.col("party"))
    first = order.groupBy("pool").agg(F.min("row").alias("first"))
    won = order.join(first, "pool").join(left, "pool").where("row - first < left") \
        .groupBy("party").agg(F.count(F.lit(1)).alias("won"))
    return p.join(won, "party", "left").select(
        "party", (F.col("base") + F.coalesce("won", F.lit(0))).alias("seats"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every document."""
    sizes = cut(document_sizes(docs))
    sources = source_targets(sizes)
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, min(MOST_BLOCK_WORDS, words // LEAST_BLOCKS))
    blocks = round(SHARE * words / block)
    seats = apportion(sources.select(F.lit(0).alias("pool"), "party", F.col("target").alias("weight"),
                                     F.lit(blocks).alias("seats")))
    sources = cut(sources.join(seats, "party", "left").withColumn("seats", F.coalesce("seats", F.lit(0))))
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    number = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(SHARD_WORDS)))
    known = sources.select(F.col("source").alias("_s"), "party", "source_size", "target", "seats")
    rows = sizes.join(known, sizes["source"].eqNullSafe(known["_s"])).drop("_s").withColumn("h", h) \
        .withColumn("shard", F.pmod(number, shards))
    own = W.partitionBy("party", "shard").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = cut(rows.select("doc_id", "size", "source_size", "target", "party", "shard", "seats",
                           F.sum("size").over(own).alias("stop")))
    per = rows.groupBy("party", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats"))
    per = ranked(per, F.col("party"), F.col("shard"), name="place")
    per = cut(per.withColumn("blocks", F.when(F.col("words") > 0, F.greatest(
        F.lit(1), F.round(F.col("words") / F.lit(block)).cast("long"))).otherwise(F.lit(0))))
    quota = apportion(per.select(F.col("party").alias("pool"), F.col("place").alias("party"),
                                 F.col("words").alias("weight"), "seats"))
    mark = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "party", "shard")), 1, 7), 16, 10).cast("long")
    prime = F.element_at(F.array(*[F.lit(x) for x in PRIMES]), (mark % len(PRIMES)).cast("int") + 1)
    quota = per.join(quota.toDF("place", "quota"), "place", "left").select(
        "party", "shard", "words", "blocks", mark.alias("mark"), prime.cast("long").alias("prime"),
        F.least(F.coalesce("quota", F.lit(0)), CAP * F.col("blocks")).alias("quota"))
    # the first shards with room take what is left of the target, or give back what is beyond it
    quota = quota.where("words > 0").withColumn("base", F.expr("quota * words div blocks")).join(
        sources.select("party", F.round("target").cast("long").alias("due")), "party")
    party, before = W.partitionBy("party"), W.partitionBy("party").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    quota = quota.withColumn("left", F.col("due") - F.sum("base").over(party)).withColumn(
        "room", F.when(F.col("left") > 0, CAP * F.col("words") - F.col("base")).otherwise(F.col("base")))
    share = F.least("room", F.greatest(F.lit(0), F.abs("left") - F.coalesce(F.sum("room").over(before), F.lit(0))))
    quota = quota.withColumn("quota", F.col("base") + F.signum(F.col("left")).cast("long") * share)
    quota = quota.withColumn("full", F.expr("quota % words * blocks div words")).withColumn(
        "part", F.expr("quota % words - full * words div blocks")).drop("base", "due", "left", "room")
    at = rows.join(quota, ["party", "shard"], "left").withColumn("start", F.col("stop") - F.col("size"))
    extra = F.expr("""
        aggregate(sequence(((start + 1) * blocks - 1) div words, (stop * blocks - 1) div words), 0L,
                  (sum, b) -> sum + case
                      when pmod(b * prime + mark, blocks) < full then
                          least(stop, (b + 1) * words div blocks) - greatest(start, b * words div blocks)
                      when pmod(b * prime + mark, blocks) = full then greatest(0L,
                          least(stop, (b + 1) * words div blocks, b * words div blocks + part)
                          - greatest(start, b * words div blocks))
                      else 0L end)""")
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.expr("quota div words") * F.col("size") + extra)
    return at.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents: each as often as the words taken from it say.

    A document whose words are taken ``x`` times gets floor(x) or ceil(x)
    copies, the latter with the probability of the remainder by a seeded hash,
    so that sources keep their targets.  Rows that repeat a doc_id share its
    total.
    """
    got = mix(docs, seed).groupBy("doc_id").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    ratio = F.col("taken") / F.greatest(F.col("size"), F.lit(1))
    chance = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:copy:"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    own, copies, copy = free_names(docs, "_id", "_copies", "_copy")
    got = got.select(F.col("doc_id").alias(own), F.floor(ratio + chance).cast("int").alias(copies)).where(F.col(copies) > 0)
    out = docs.join(got, F.col(own).eqNullSafe(F.col("doc_id")))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(own, copies, copy)
