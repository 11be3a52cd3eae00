"""Dataset-scale data tests: not_null, unique, accepted_values; report; gate.

* ``not_null`` and ``accepted_values`` of one model run as ONE aggregate pass:
  every check is a ``count_if`` in the same ``agg``, so each task folds its
  rows into a handful of counters and only one row per task is shuffled.
* ``unique`` cannot be pre-aggregated away (distinct keys stay distinct), so
  it is the full-shuffle case.  It runs in two phases: first the 8-byte
  xxhash64 of each value is shuffled (instead of the value itself); if no
  hash repeats, no value does.  Otherwise the values are counted in one full
  shuffle.  A hot value is collapsed by the partial count of each task in
  both phases; nothing is joined or broadcast.

NULLs are ignored by ``unique`` and ``accepted_values`` (``not_null`` catches
them).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from unilake.session import size_shuffles

REPORT_SCHEMA = StructType([
    StructField("model", StringType(), False),
    StructField("column_name", StringType(), False),
    StructField("check_name", StringType(), False),
    StructField("failures", LongType(), False),
])

@dataclass(frozen=True)
class Check:
    kind: str                      # "not_null" | "unique" | "accepted_values"
    column: str
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.kind


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted_values(column: str, values: Iterable[str]) -> Check:
    return Check("accepted_values", column, tuple(values))


class QualityGateError(RuntimeError):
    """Raised when a data test fails; nothing downstream is published."""

    def __init__(self, failed: list[tuple[str, str, str, int]]):
        self.failed = failed
        lines = ", ".join(f"{m}.{c} {k}: {n}" for m, c, k, n in failed)
        super().__init__(f"{len(failed)} data test(s) failed: {lines}")


def _failure_condition(check: Check):
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    raise ValueError(check.kind)


def row_check_aggs(checks: Sequence[Check]) -> list:
    """Named ``count_if`` aggregates for the not_null / accepted_values checks
    (usable in ``agg`` or as observed metrics on a write)."""
    rc = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    return [F.count_if(_failure_condition(c)).alias(f"{c.kind}:{c.column}") for c in rc]


def reason(model: str, check: Check) -> str:
    """How a row check is named where its offending rows are kept."""
    return f"{model}|{check.kind}:{check.column}"


def failed_checks(model: str, checks: Sequence[Check]):
    """Array of the reasons for which a row fails the not_null / accepted_values
    checks; empty for a good row."""
    rc = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    if not rc:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(_failure_condition(c), F.lit(reason(model, c))) for c in rc]))


def report_rows(model: str, checks: Sequence[Check],
                counts: dict[str, int]) -> list[tuple[str, str, str, int]]:
    """Report rows from per-check failure counts keyed ``kind:column``."""
    return [(model, c.column, c.kind, int(counts.get(f"{c.kind}:{c.column}", 0)))
            for c in checks if c.kind in ("not_null", "accepted_values")]


def row_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame | None:
    """All not_null / accepted_values checks of a model in one scan."""
    rc = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    if not rc:
        return None
    counts = df.agg(*[F.count_if(_failure_condition(c)).alias(f"f{i}")
                      for i, c in enumerate(rc)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c.column).alias("column_name"),
                 F.lit(c.kind).alias("check_name"), F.col(f"f{i}").alias("failures"))
        for i, c in enumerate(rc)]))
    return counts.select(rows.alias("r")).select("r.*")


def unique_failures(df: DataFrame, column: str, two_phase: bool = True) -> int:
    """Number of distinct non-NULL values of ``column`` occurring more than once."""
    vals = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    if two_phase:
        hashed = vals.groupBy(F.xxhash64("v").alias("h")).agg(F.count(F.lit(1)).alias("n"))
        if hashed.where("n > 1").isEmpty():
            return 0
    # some hash repeats: count per value, partially in each task, so a hot
    # value is one row per task in this one full shuffle
    return vals.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()


def unique_checks(df: DataFrame, model: str, checks: Sequence[Check],
                  two_phase: bool = True) -> list[tuple[str, str, str, int]]:
    return [(model, c.column, "unique", unique_failures(df, c.column, two_phase))
            for c in checks if c.kind == "unique"]


def key_collisions(df: DataFrame, key: str, parts: Sequence[str]) -> DataFrame:
    """Keys that stand for several part tuples, and for how many (exact: the
    tuples themselves are compared, NULL positions included).  Repeated rows
    are folded in each task before anything moves, so no key is hot."""
    size_shuffles(df.sparkSession, df)
    tuples = df.groupBy(key, *parts).agg(F.lit(1).alias("_one"))
    return tuples.groupBy(key).agg(F.count(F.lit(1)).alias("tuples")).where("tuples > 1")


def run_checks(spark: SparkSession, models: Iterable[tuple[str, DataFrame, Sequence[Check]]],
               kinds: Sequence[str] = ("not_null", "unique", "accepted_values"),
               two_phase: bool = True, parallelism: int = 4) -> DataFrame:
    """Quality report: one row per (model, column, check) with its failures.

    The unique checks are independent jobs; up to ``parallelism`` of them are
    submitted at once from driver threads, so small checks share the cluster
    instead of queueing behind each other.
    """
    models = list(models)
    if models:
        size_shuffles(spark, *[df for _, df, _ in models])
    parts: list[DataFrame] = []
    jobs: list[tuple[str, DataFrame, str]] = []
    for name, df, checks in models:
        sel = [c for c in checks if c.kind in kinds]
        jobs += [(name, df, c.column) for c in sel if c.kind == "unique"]
        # an aggregate, not an observation: a stage that runs again after a
        # lost executor must not count its rows twice
        rc = row_checks(df, name, sel)
        if rc is not None:
            parts.append(rc)

    def run(job):
        name, df, column = job
        return [(name, column, "unique", unique_failures(df, column, two_phase))]

    uniq_rows: list[tuple[str, str, str, int]] = []
    if jobs:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs)))) as pool:
            for rows in pool.map(run, jobs):
                uniq_rows += rows
    if uniq_rows:
        parts.append(spark.createDataFrame(uniq_rows, REPORT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def gate(report: DataFrame) -> list[tuple[str, str, str, int]]:
    """Raise :class:`QualityGateError` if any check failed (report is tiny)."""
    failed = [(r["model"], r["column_name"], r["check_name"], int(r["failures"]))
              for r in report.where("failures > 0").collect()]
    if failed:
        raise QualityGateError(failed)
    return failed
