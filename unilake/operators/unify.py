"""Unification: align N staged sources to one canonical schema, union, key.

Each branch is a single projection over its staged source: the source tag is
a literal (so a filter on it drops whole branches at plan time), fields the
source lacks become typed NULLs, every field is cast to the canonical type
before the union, and the surrogate key is computed inside the branch (the
literal tag constant-folds into it).  ``unionByName`` then concatenates the
branches' partitions: the whole model is narrow -- no Exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from unilake.functions import exprs


@dataclass(frozen=True)
class Branch:
    """One source's contribution to a unified model.

    ``staged`` names the staging model it reads; ``fields`` maps canonical
    column -> expression builder over the staged frame (default: the
    same-named staged column, else a typed NULL).
    """

    source_system: str
    staged: str
    fields: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


@dataclass(frozen=True)
class UnifiedModel:
    name: str
    schema: StructType            # canonical schema, key first, loaded_at last
    key_name: str                 # e.g. "customer_sk"
    key_parts: tuple[str, ...]    # e.g. ("source_system", "source_customer_id")
    branches: tuple[Branch, ...]
    source_column: str = "source_system"
    stamp_column: str = "loaded_at"
    comment: str = ""
    tests: tuple = ()
    # Maximum staleness when published by a refresh job (freshness bound).
    target_lag: str = "1 minute"
    layer: str | None = None      # custom schema; default: intermediate
    key_framing: str = "separator"    # or "length": see exprs.surrogate_key

    @property
    def data_fields(self):
        return [f for f in self.schema.fields
                if f.name not in (self.key_name, self.stamp_column)]

    @property
    def content_columns(self) -> list[str]:
        """Columns that define a row's content (everything but the stamp)."""
        return [f.name for f in self.schema.fields if f.name != self.stamp_column]


def align(staged: DataFrame, branch: Branch, model: UnifiedModel,
          loaded_at: Column | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Project one staged source onto the canonical schema (narrow); ``extra``
    columns of the staged rows follow."""
    cols: dict[str, Column] = {}
    present = set(staged.columns)
    for f in model.data_fields:
        if f.name == model.source_column:
            c = F.lit(branch.source_system)
        elif f.name in branch.fields:
            c = branch.fields[f.name]()
        elif f.name in present:
            c = F.col(f.name)
        else:
            c = exprs.typed_null(f.dataType)
        cols[f.name] = c.cast(f.dataType)
    key = exprs.surrogate_key(*[cols[p] for p in model.key_parts], framing=model.key_framing)
    key_meta = model.schema[model.key_name].metadata
    out = [key.alias(model.key_name, metadata=key_meta) if key_meta else key.alias(model.key_name)]
    out += [cols[f.name].alias(f.name, metadata=f.metadata) if f.metadata
            else cols[f.name].alias(f.name) for f in model.data_fields]
    if loaded_at is not None:
        out.append(loaded_at.cast("timestamp").alias(model.stamp_column))
    return staged.select(*out, *extra)


def unify(model: UnifiedModel, staged: Mapping[str, DataFrame],
          loaded_at: Column | None | bool = True,
          sources: Sequence[str] | None = None) -> DataFrame:
    """Build a unified model from its staged inputs.

    ``staged`` maps staging-model name -> DataFrame.  ``loaded_at``: ``True``
    stamps ``current_timestamp()`` (one value per query), a Column stamps
    that value (e.g. the audited load time, for reproducible rebuilds),
    ``False``/``None`` leaves the stamp out.  ``sources`` restricts the build
    to some source systems (used by per-source refresh).
    """
    if loaded_at is True:
        stamp = F.current_timestamp()
    elif loaded_at is False or loaded_at is None:
        stamp = None
    else:
        stamp = loaded_at
    parts = [align(staged[b.staged], b, model, stamp) for b in model.branches
             if sources is None or b.source_system in sources]
    if not parts:
        raise ValueError(f"no branch of {model.name} selected")
    return reduce(lambda x, y: x.unionByName(y), parts)
