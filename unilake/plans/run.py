"""One full build: land -> stage -> unify -> check -> publish -> summarise.

Every step is a Spark job over the lake; the driver only sequences them and
reads tiny control data (audit rows, pointers, the summary).  Independent
models publish side by side; a failed data test keeps only the failing
model unpublished.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from unilake.operators.quality import QualityGateError
from unilake.operators.report import SUMMARY_SCHEMA, tolerant_summary
from unilake.plans.layers import INTERMEDIATE_LAYER, Publisher, register_staging_views
from unilake.plans.models import UNIFIED
from unilake.sources.landing import RAW_LAYER, Lake

log = logging.getLogger(__name__)


def build_all(lake: Lake, sources: Mapping[str, Mapping[str, DataFrame] | str],
              models: Sequence[str] | None = None,
              on_gate_failure: str = "raise", parallelism: int = 4,
              lenient_dates: bool = False) -> DataFrame:
    """Land every source as one load, publish every model, return the summary
    (layer, table_name, row_count, status, error) of raw and published tables.

    The unified models are independent, so up to ``parallelism`` of them are
    published side by side; a model whose data tests fail stays unpublished
    and the others still publish.  ``on_gate_failure='raise'`` then raises
    the first failure; ``'report'`` returns the summary with that model's
    ``status='gate_failed'``.
    """
    landed = lake.land_many(sources)
    log.info("landed %d raw tables", len(landed))
    register_staging_views(lake, persistent=True)
    pub = Publisher(lake, lenient_dates=lenient_dates)
    names = list(models or UNIFIED)
    loads = lake.current_loads()
    todo = [n for n in names if any(r in loads for r in _raw_inputs(UNIFIED[n]))]

    def publish(name: str):
        try:
            pub.publish(UNIFIED[name])
            return None
        except QualityGateError as exc:
            log.error("%s not published: %s", name, exc)
            return exc

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(todo) or 1))) as pool:
        outcomes = list(pool.map(publish, todo))
    published = [n for n, e in zip(todo, outcomes) if e is None]
    errors = [(n, e) for n, e in zip(todo, outcomes) if e is not None]
    if errors and on_gate_failure == "raise":
        raise errors[0][1]
    failed = [(INTERMEDIATE_LAYER, n, None, "gate_failed", str(e)) for n, e in errors]
    # raw counts were observed while the tables were written
    raw = lake.spark.createDataFrame(
        [(RAW_LAYER, n, loads[n][2], "ok", None) for n in sorted(loads)], SUMMARY_SCHEMA)
    tables = [(INTERMEDIATE_LAYER, n, (lambda n=n: pub.read(n))) for n in published]
    out = raw.unionByName(tolerant_summary(lake.spark, tables))
    if failed:
        out = out.unionByName(lake.spark.createDataFrame(failed, out.schema))
    return out


def _raw_inputs(model) -> list[str]:
    from unilake.plans.models import STAGING
    return [STAGING[b.staged].raw_name for b in model.branches]
