"""Staging: declarative column mappings (rename, cast, derive, constant).

A staging model is 1:1 with its raw table: one ``select`` of renamed / cast
columns.  It never filters or shuffles, so Catalyst folds it into the scan's
projection (column pruning and predicate pushdown reach the parquet reader).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unilake.functions import exprs


@dataclass(frozen=True)
class Field:
    """One output column of a staging model.

    ``source`` names the input column (default: same name); ``cast`` is a
    Spark type name; ``derive`` builds the column from scratch and wins over
    ``source``; ``const`` is a literal.  ``cast='date'`` uses the ISO-date
    rule (strict unless the model is staged leniently).
    """

    name: str
    source: str | None = None
    cast: str | None = None
    derive: Callable[[], Column] | None = None
    const: object = None
    comment: str = ""
    sql: str | None = None        # SQL text of ``derive`` (for persistent views)

    def column(self, lenient_dates: bool = False) -> Column:
        if self.derive is not None:
            c = self.derive()
        elif self.const is not None:
            c = F.lit(self.const)
        else:
            c = F.col(self.source or self.name)
        if self.cast == "date":
            c = exprs.iso_date(c, lenient=lenient_dates)
        elif self.cast:
            c = c.cast(self.cast)
        meta = {"comment": self.comment} if self.comment else None
        return c.alias(self.name, metadata=meta) if meta else c.alias(self.name)


def keep(name: str, comment: str = "") -> Field:
    return Field(name, comment=comment)


def rename(source: str, name: str, comment: str = "") -> Field:
    return Field(name, source=source, comment=comment)


def cast(source: str, name: str, dtype: str, comment: str = "") -> Field:
    return Field(name, source=source, cast=dtype, comment=comment)


def derive(name: str, fn: Callable[[], Column], comment: str = "",
           sql: str | None = None) -> Field:
    return Field(name, derive=fn, comment=comment, sql=sql)


@dataclass(frozen=True)
class StagingModel:
    """A raw table's staging view: ``stg_<source>__<table>``."""

    source: str
    table: str
    fields: tuple[Field, ...]
    comment: str = ""
    tests: tuple = field(default_factory=tuple)   # quality.Check declarations
    layer: str | None = None                      # custom schema; default: staging

    @property
    def name(self) -> str:
        return f"stg_{self.source}__{self.table}"

    @property
    def raw_name(self) -> str:
        return f"raw_{self.source}__{self.table}"


def stage(raw: DataFrame, model: StagingModel, lenient_dates: bool = False) -> DataFrame:
    """Apply a staging model to its raw table: one narrow projection."""
    return raw.select(*[f.column(lenient_dates) for f in model.fields])


def _sql_literal(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def staging_sql(model: StagingModel, relation: str) -> str:
    """The staging model as SQL text over ``relation`` (for a persistent view
    that re-resolves when the relation is repointed to a new load)."""
    cols = []
    for f in model.fields:
        if f.derive is not None:
            if f.sql is None:
                raise ValueError(f"{model.name}.{f.name}: derived field has no SQL text")
            expr = f"({f.sql})"
        elif f.const is not None:
            expr = _sql_literal(f.const)
        else:
            expr = f"`{f.source or f.name}`"
        if f.cast:
            expr = f"CAST({expr} AS {f.cast.upper()})"
        cols.append(f"{expr} AS `{f.name}`")
    return f"SELECT {', '.join(cols)} FROM {relation}"


def date_reject_counts(raw: DataFrame, model: StagingModel) -> DataFrame:
    """One row: per date field, how many non-NULL texts fail to parse.

    The companion of lenient staging: a single aggregate pass (partial
    aggregation per task, one tiny final merge), no shuffle of rows.
    """
    date_fields = [f for f in model.fields if f.cast == "date"]
    if not date_fields:
        raise ValueError(f"{model.name} has no date field")
    return raw.agg(*[F.sum(exprs.date_rejects(F.col(f.source or f.name))).cast("long")
                     .alias(f.name) for f in date_fields])
