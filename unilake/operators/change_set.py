"""Change set between two snapshots of a table: insert / update / delete.

Instead of a full outer join, both snapshots are reduced to
(key, 64-bit content hash) and unioned, then grouped by key once: a single
shuffle of narrow rows, with map-side partial aggregation.  A join would
pair every old row of a key with every new row of it; the grouping never
emits pairs, so a key repeated in a third of all rows costs one partial
aggregate per task, not a quadratic blow-up.

For each key: no old row -> ``insert``; no new row -> ``delete``; one row
on each side with equal hashes -> ``unchanged``; otherwise ``update``.
A repeated key compares as a multiset: equal counts and equal order-free sums
of two independent hashes on both sides.  The hash covers every compared column and their NULL positions (see
:func:`unilake.functions.exprs.row_hash`); leave build stamps such as
``loaded_at`` out of ``compare``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unilake.functions.exprs import row_hash
from unilake.session import size_shuffles

CHANGE_TYPES = ("insert", "update", "delete", "unchanged")


def change_set(old: DataFrame, new: DataFrame, key: Sequence[str],
               compare: Sequence[str] | None = None, payload: bool = False,
               include_unchanged: bool = False, hash_column: str | None = None) -> DataFrame:
    """Classify every key of ``old`` and ``new``.

    Returns ``key columns + change_type`` (plus ``new_row``, a struct of the
    new values for inserts and updates, when ``payload`` is set).
    ``hash_column`` names a content hash both sides already carry (e.g. the
    one stored with published versions): then only the key and that column
    are read, not every compared column.
    """
    key = list(key)
    if compare is None:
        compare = [c for c in new.columns if c not in key and c != hash_column]
    compare = list(compare)

    def side(df: DataFrame, is_new: int) -> DataFrame:
        cols = [F.col(k) for k in key]
        h = F.col(hash_column) if hash_column else row_hash(compare)
        cols += [h.alias("_h"), F.lit(is_new == 1).alias("_is_new")]
        if payload:
            rec = F.struct(*[F.col(c) for c in compare]) if is_new else \
                F.lit(None).cast(new.select(F.struct(*compare).alias("s")).schema["s"].dataType)
            cols.append(rec.alias("_row"))
        return df.select(*cols)

    size_shuffles(new.sparkSession, old, new)
    u = side(old, 0).unionByName(side(new, 1))

    def balance(h):
        """New minus old, 0 for equal multisets: the halves of the hash summed as
        longs, which 2**31 rows of a key can't overflow."""
        sign = F.when(F.col("_is_new"), F.lit(1)).otherwise(F.lit(-1)).cast("long")
        return [F.sum(sign * F.shiftrightunsigned(h, 32)), F.sum(sign * h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))]

    is_new = F.col("_is_new")
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.count_if(is_new).alias("_n_new"),
        *[x.alias(f"_sum{i}") for i, x in enumerate(balance(F.col("_h")) + balance(F.xxhash64("_h")))],
    ]
    if payload:
        aggs.append(F.max("_row").alias("new_row"))   # the largest, should a key repeat
    g = u.groupBy(*key).agg(*aggs).withColumn("_n_old", F.col("_n") - F.col("_n_new"))
    same = (F.col("_n_old") == F.col("_n_new")) & F.expr(" and ".join(f"_sum{i} = 0" for i in range(4)))
    change = (F.when(F.col("_n_old") == 0, F.lit("insert"))
              .when(F.col("_n_new") == 0, F.lit("delete"))
              .when(same, F.lit("unchanged"))
              .otherwise(F.lit("update")))
    out = g.withColumn("change_type", change)
    if not include_unchanged:
        out = out.where(F.col("change_type") != "unchanged")
    keep = key + ["change_type"] + (["new_row"] if payload else [])
    return out.select(*keep)

