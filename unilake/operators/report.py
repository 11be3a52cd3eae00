"""Readouts: row counts per published table, previews, schema descriptions
and schema-contract checks.

Counts are lazy single-row aggregates unioned into one frame (one job, each
branch a partial count per task).  Schema readouts come from the analyzed
plan only -- they never scan data.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DataType, DateType,
                               DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

log = logging.getLogger(__name__)

# --- fixed values: SQL type names used in schema readouts ---------------------
_SQL_TYPE_NAMES: list[tuple[type, str]] = [
    (StringType, "VARCHAR"), (LongType, "BIGINT"), (IntegerType, "INTEGER"),
    (ShortType, "SMALLINT"), (ByteType, "TINYINT"), (DoubleType, "DOUBLE"),
    (FloatType, "FLOAT"), (BooleanType, "BOOLEAN"), (DateType, "DATE"),
    (TimestampNTZType, "TIMESTAMP"), (TimestampType, "TIMESTAMP WITH TIME ZONE"),
    (BinaryType, "BLOB"),
]
# -----------------------------------------------------------------------------


def sql_type(t: DataType) -> str:
    """ANSI-style name of a Spark type (the names other SQL engines print)."""
    if isinstance(t, DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    for cls, name in _SQL_TYPE_NAMES:
        if type(t) is cls:
            return name
    return t.simpleString().upper()


COUNT_SCHEMA = StructType([
    StructField("layer", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("row_count", LongType(), False),
])


def layer_summary(tables: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """COUNT(*) of every (layer, table, frame), as one lazy frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for layer, name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SUMMARY_SCHEMA = "layer string, table_name string, row_count long, status string, error string"


def tolerant_summary(spark: SparkSession,
                     tables: Iterable[tuple[str, str, Callable[[], DataFrame]]],
                     parallelism: int = 4) -> DataFrame:
    """Like :func:`layer_summary` but an unreadable table becomes a warning row
    (``status='unreadable'``, ``row_count`` NULL) instead of failing.  Each
    table is its own count job; a few run side by side."""
    def one(item):
        layer, name, make = item
        try:
            return (layer, name, make().count(), "ok", None)
        except Exception as exc:  # noqa: BLE001 - tolerant by design
            log.warning("could not read %s.%s: %s", layer, name, exc)
            return (layer, name, None, "unreadable", str(exc))

    items = list(tables)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items) or 1))) as pool:
        rows = list(pool.map(one, items))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (TakeOrderedAndProject: a per-task top-n,
    merged on one task -- never a full sort)."""
    return df.orderBy(*order_by).limit(n)


def null_counts(df: DataFrame) -> dict[str, int]:
    """NULLs per column in one aggregate pass (a partial count per task)."""
    cols = df.columns
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return {c: int(row[i]) for i, c in enumerate(cols)}


DESCRIBE_SCHEMA = StructType([
    StructField("model", StringType(), False),
    StructField("ordinal", IntegerType(), False),
    StructField("column_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("null_count", LongType(), True),
    StructField("required", BooleanType(), False),
    StructField("comment", StringType(), True),
])


def describe(spark: SparkSession, models: Iterable[tuple[str, DataFrame]],
             required: dict[str, Sequence[str]] | None = None, scan: bool = True) -> DataFrame:
    """One row per column of each model: type, NULLs counted in one pass over
    the model (``scan``), and whether a consumer requires it.  A required
    column that the model lacks is an error."""
    rows = []
    for m, df in models:
        need = list((required or {}).get(m, ()))
        if lacking := missing_required(df.schema, need):
            raise ValueError(f"{m} lacks required columns: {', '.join(lacking)}")
        nulls = null_counts(df) if scan else {}
        rows += [(m, i + 1, f.name, sql_type(f.dataType), nulls.get(f.name), f.name in need,
                  f.metadata.get("comment")) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, DESCRIBE_SCHEMA)


CONTRACT_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("column_name", StringType(), False),
    StructField("expected_type", StringType(), True),
    StructField("actual_type", StringType(), True),
    StructField("status", StringType(), False),
    StructField("null_count", LongType(), True),
])


def contract_rows(table: str, actual: StructType, expected: StructType,
                  nulls: dict[str, int] | None = None) -> list[tuple]:
    """Compare a frame's schema with its declared contract.

    status: ``ok`` | ``missing`` (declared, absent) | ``extra`` (present,
    undeclared) | ``type_mismatch``.  Names compare case-insensitively.
    """
    act = {f.name.lower(): f for f in actual.fields}
    exp = {f.name.lower(): f for f in expected.fields}
    rows = []
    for name, f in exp.items():
        if name not in act:
            rows.append((table, name, sql_type(f.dataType), None, "missing"))
        else:
            a, e = sql_type(act[name].dataType), sql_type(f.dataType)
            rows.append((table, name, e, a, "ok" if a == e else "type_mismatch"))
    for name, f in act.items():
        if name not in exp:
            rows.append((table, name, None, sql_type(f.dataType), "extra"))
    have = {k.lower(): v for k, v in (nulls or {}).items()}
    return [(*r, have.get(r[1])) for r in rows]


def contract_check(spark: SparkSession,
                   checks: Iterable[tuple]) -> DataFrame:
    """(table, actual schema, expected schema[, NULLs per column]) -> contract rows."""
    rows = [r for check in checks for r in contract_rows(*check)]
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def missing_required(actual: StructType, required: Iterable[str]) -> list[str]:
    """Required columns absent from a schema (expected minus actual)."""
    have = {f.name.lower() for f in actual.fields}
    return [c for c in required if c.lower() not in have]
