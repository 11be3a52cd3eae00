"""Helpers shared by the operators: lineage cuts, connected components, ranks."""

from __future__ import annotations

from collections.abc import Callable
from threading import get_ident

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from unilake.session import fresh_dir, delete_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By thread, the paths that ``cut`` writes while ``settled`` runs (plain data: tasks get this module by value).
_MADE: dict[int, list[str]] = {}
#: Bits of the filter of ``sift`` (4 MB, whatever the number of keys).
SIFT_BITS = 1 << 25


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    Later stages start from those files, so a lost executor costs no more than
    its own tasks, and plans and size estimates start anew.  The folder is
    the one that ``spark.checkpoint.dir`` names; ``drop`` removes the table.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "llm")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # its shuffle files go with the query
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._unilake_path = path
    _MADE.get(get_ident(), []).append(path)
    return out


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """``cut(make())``; the tables that ``make`` cuts on the way are removed."""
    thread, made, out = get_ident(), [], None
    outer = _MADE.get(thread)
    _MADE[thread] = made
    try:
        out = cut(make())
    finally:
        if outer is None:
            del _MADE[thread]
        else:
            _MADE[thread] = outer
        spark = SparkSession.active()
        for path in made[:-1] if out is not None else made:
            delete_path(spark, path)
    if outer is not None:
        outer.append(out._unilake_path)
    return out


def bound_batches(spark: SparkSession, size: int = 1 << 24) -> None:
    """Hand rows to Python workers in Arrow batches of at most about ``size``
    bytes, whatever their number of rows (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def drop(*tables: DataFrame | None) -> None:
    """Remove tables made by ``cut`` that nothing reads any more (other frames
    are left alone)."""
    for t in tables:
        path = getattr(t, "_unilake_path", None)
        if path is not None:
            delete_path(t.sparkSession, path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of a documents-like table, under their own names only.

    Extra columns of any name are left out here, so they cannot clash with the
    columns that an operator adds.
    """
    return df.select(*[df[c] for c in columns])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has such a column (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def sift(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is surely not in ``keys``, all other rows) of ``df``.

    ``keys`` has one column.  A bitmap of the keys' hashes, of a fixed size, is
    sent to all tasks, so neither part is shuffled.  The second part holds every
    row whose key is listed (null among them, if listed) and some others: an
    exact join follows.
    """
    def slot(c: Column) -> Column:  # 1 .. SIFT_BITS, as the bitmap functions number them
        return F.pmod(F.xxhash64(c), F.lit(SIFT_BITS)) + F.lit(1)

    bits = keys.select(slot(keys[keys.columns[0]]).alias("slot")).groupBy(
        F.bitmap_bucket_number("slot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    at = F.bitmap_bit_position(slot(df[key]))
    byte = F.hex(F.substring(bits["bits"], F.shiftright(at, 3).cast("int") + 1, F.lit(1)))
    held = F.getbit(F.conv(byte, 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1
    listed = (F.bitmap_bucket_number(slot(df[key])) == bits["bucket"]) & held
    return tuple(df.join(F.broadcast(bits), listed, how) for how in ("left_anti", "left_semi"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the smallest node reachable by edges.

    Each round points every node to its smallest neighbour, follows the
    pointers three times and contracts the graph.  A node that is not the
    smallest of its neighbourhood disappears, so rounds are logarithmic.  Only
    joins and minima are used: a hub's edges are never gathered in one place.
    Nodes without an edge are not listed.
    """
    e = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not e.isEmpty():
        up = cut(e.union(e.select("b", "a")).groupBy("a").agg(F.min("b").alias("low"))
                 .select(F.col("a").alias("node"), F.least("a", "low").alias("p1")))
        far = up
        for x, y in (("p1", "p2"), ("p2", "p3")):
            far = far.join(up.select(F.col("node").alias(x), F.col("p1").alias(y)), x)
        far = cut(far.select("node", "p2", "p3"))
        to = far.select(F.col("node").alias("component"), F.col("p2").alias("to"))
        if labels is None:
            new = far.select("node", F.col("p2").alias("component"))
        else:
            new = labels.join(to, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component"))
        new = cut(new)
        nxt = e.join(to.toDF("a", "ta"), "a").join(to.toDF("b", "tb"), "b").select(
            F.col("ta").alias("a"), F.col("tb").alias("b"))
        nxt = nxt.union(far.select(F.col("p2").alias("a"), F.col("p3").alias("b")))
        nxt = cut(nxt.where("a <> b").select(F.least("a", "b").alias("a"),
                                             F.greatest("a", "b").alias("b")).distinct())
        drop(e, up, far, labels)
        e, labels = nxt, new
    if labels is not None:
        drop(e)
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def totals_before(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """``df`` with, for each ``name=column``, the column's total over all rows
    before the row in ``order``, which must be total.

    A range sort deals the order to partitions; each holds its rows' running
    sums, and one offset per partition is added (a table of as many rows as
    partitions, which alone is summed in one task).
    """
    s = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    s = s.withColumn("_part", F.shiftright("_at", 33))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    per = s.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    offsets = per.select("_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in sums])
    own = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    out = s.join(F.broadcast(offsets), "_part")
    for n, c in sums.items():
        out = out.withColumn(n, F.coalesce(F.sum(c).over(own), F.lit(0)) + F.col(f"_off_{n}"))
    return out.drop("_part", "_at", *[f"_off_{n}" for n in sums])


def ranked(df: DataFrame, *order: Column, name: str = "row") -> DataFrame:
    """``df`` with a gapless row number from 0 in ``order``, without a
    one-task window: a range sort, then one offset per sorted partition (a
    table of as many rows as partitions).  The order must be total."""
    s = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    s = s.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(
        F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return s.join(F.broadcast(before), "_part").withColumn(name, F.col("_off") + F.col("_pos")) \
        .drop("_part", "_pos", "_at", "_off")
