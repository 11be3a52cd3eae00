"""Compose the layers: raw -> staging -> unified, as lazy DataFrames.

Nothing here executes a job: the functions return DataFrame plans that
Catalyst optimises as a whole (column pruning and filters reach the scans,
union branches with a non-matching source tag are dropped).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from unilake.operators.mapping import stage
from unilake.operators.unify import UnifiedModel, unify
from unilake.plans.models import STAGING, UNIFIED, inputs_of
from unilake.sources import adapters


def staged_frames(raw: Mapping[str, DataFrame], names: list[str] | None = None,
                  lenient_dates: bool = False) -> dict[str, DataFrame]:
    """staging-model name -> staged DataFrame, for every raw table given."""
    out = {}
    for name, model in STAGING.items():
        if names is not None and name not in names:
            continue
        if model.raw_name in raw:
            out[name] = stage(raw[model.raw_name], model, lenient_dates)
    return out


def staged_from_tables(spark: SparkSession, sf_dir: str,
                       names: list[str] | None = None) -> dict[str, DataFrame]:
    wanted = None
    if names is not None:
        wanted = {STAGING[n].raw_name for n in names}
    return staged_frames(adapters.raw_frames(spark, sf_dir, wanted), names)


def unified_from_tables(spark: SparkSession, sf_dir: str, model: str | UnifiedModel,
                        loaded_at: Column | bool | None = True) -> DataFrame:
    m = UNIFIED[model] if isinstance(model, str) else model
    return unify(m, staged_from_tables(spark, sf_dir, inputs_of(m)), loaded_at=loaded_at)


def staging_from_tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return staged_from_tables(spark, sf_dir, [name])[name]
