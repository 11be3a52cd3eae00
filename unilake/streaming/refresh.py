"""Keeping published models fresh: staleness, batch refresh, streaming refresh.

A unified model is kept within a freshness bound (``target_lag``, one
minute by default) of its raw sources:

* :func:`staleness` compares, per source, the newest audited raw load with
  the version the model's pointer names.
* :func:`snapshot_refresh` rebuilds only the sources that changed (see
  :meth:`Publisher.publish`).
* :func:`start_stream_refresh` runs that as a Structured Streaming query:
  its input is the append-only load audit (one row per landed table), so a
  micro-batch fires when a load *commits* -- including an empty snapshot,
  which a stream over the data files could not see.  ``foreachBatch`` maps
  the batch's raw tables to the models they feed and publishes those.  The
  stream's checkpoint sits in the shared folder, so a restarted driver
  resumes where it stopped; publication is idempotent (a committed version
  is never rewritten, an unchanged pointer is not re-written), so a
  replayed micro-batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from unilake.operators.quality import QualityGateError
from unilake.operators.unify import UnifiedModel
from unilake.plans.layers import Publisher, PublishResult
from unilake.plans.models import STAGING, UNIFIED
from unilake.sources.landing import AUDIT_SCHEMA, Lake

log = logging.getLogger(__name__)


def parse_lag(lag: str | int | float) -> float:
    """'1 minute' / '30 seconds' / '2 hours' / seconds -> seconds."""
    if isinstance(lag, (int, float)):
        return float(lag)
    n, unit = lag.split()
    unit = unit.rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return float(n) * mult


def model_inputs(model: UnifiedModel) -> dict[str, str]:
    """source system -> raw table name feeding that branch."""
    return {b.source_system: STAGING[b.staged].raw_name for b in model.branches}


def staleness(publisher: Publisher, model: UnifiedModel | str,
              now: dt.datetime | None = None) -> list[dict]:
    """Per source: published version, newest audited load and how long the
    newest unpublished load has been waiting (0 when up to date)."""
    m = UNIFIED[model] if isinstance(model, str) else model
    now = now or dt.datetime.now(dt.timezone.utc)
    loads = publisher.lake.current_loads()
    ptr = publisher.pointer(m)
    out = []
    for source, raw in model_inputs(m).items():
        cur = loads.get(raw)
        published = ptr.versions.get(source)
        newest = cur[0] if cur else None
        changed = newest is not None and newest != published
        waiting = (now - cur[1]).total_seconds() if changed else 0.0
        out.append({"source": source, "raw_table": raw, "published_version": published,
                    "newest_load": newest, "changed": changed, "waiting_seconds": waiting})
    return out


def needs_refresh(status: Iterable[dict], target_lag: str | float = "1 minute",
                  min_wait: float = 0.0) -> bool:
    """Refresh when some source has an unpublished load that has waited at
    least ``min_wait`` seconds, or has waited past the freshness bound."""
    bound = parse_lag(target_lag)
    for s in status:
        if s["changed"] and (s["waiting_seconds"] >= min(min_wait, bound)):
            return True
    return False


def overdue(status: Iterable[dict], target_lag: str | float = "1 minute") -> bool:
    """True when an unpublished load is older than the freshness bound."""
    bound = parse_lag(target_lag)
    return any(s["changed"] and s["waiting_seconds"] > bound for s in status)


def snapshot_refresh(publisher: Publisher, model: UnifiedModel | str,
                     gate: bool = True) -> PublishResult:
    """Rebuild only the changed sources of a model and swap its pointer."""
    return publisher.publish(model, gate=gate)


def models_fed_by(raw_tables: Iterable[str],
                  models: Sequence[UnifiedModel]) -> list[UnifiedModel]:
    raw = set(raw_tables)
    return [m for m in models if raw & set(model_inputs(m).values())]


REFRESH_LOG_SCHEMA = "model string, batch_id long, status string, detail string, at timestamp"


def refresh_log(lake: Lake) -> DataFrame:
    """Failed publications recorded by the refresh stream (one row per failure)."""
    from unilake.session import path_exists
    path = f"{lake.root}/_refresh_log"
    if not path_exists(lake.spark, path):
        return lake.spark.createDataFrame([], REFRESH_LOG_SCHEMA)
    return lake.spark.read.schema(REFRESH_LOG_SCHEMA).parquet(path)


def start_stream_refresh(lake: Lake, models: Sequence[UnifiedModel | str] | None = None,
                         checkpoint: str | None = None, available_now: bool = False,
                         trigger: str | None = None, gate: bool = True,
                         query_name: str | None = None,
                         on_gate_failure: str = "record",
                         lenient_dates: bool = False, by_deadline: bool = False,
                         ledger: bool = False) -> StreamingQuery:
    """Start the refresh stream over the lake's load audit.

    ``trigger`` defaults to half the models' tightest ``target_lag``: a load
    is picked up within half the bound and has the other half to publish, so
    staleness stays within the bound; ``available_now``
    processes what is there and stops (tests, catch-up runs).  A load that
    fails a model's data tests is not published; with
    ``on_gate_failure='record'`` the failure goes to :func:`refresh_log` and
    the stream keeps serving the other models (the failing one stays on its
    previous state and shows up as stale), with ``'raise'`` the stream stops.

    ``by_deadline``: a micro-batch stays open while its loads may still wait
    (see :mod:`unilake.streaming.schedule`), so loads that land in the meantime
    are published together; a driver lost while it waits replays the batch.
    ``ledger``: seconds from landing to publication are entered after each
    micro-batch (see :mod:`unilake.streaming.freshness`).
    """
    spark = lake.spark
    ms = [UNIFIED[m] if isinstance(m, str) else m for m in (models or UNIFIED.values())]
    publisher = Publisher(lake, lenient_dates=lenient_dates)
    checkpoint = checkpoint or f"{lake.root}/_checkpoints/refresh-" + "-".join(m.name for m in ms)
    from unilake.session import path_exists
    if not path_exists(spark, lake.audit_path):   # the file source needs its folder
        spark.createDataFrame([], AUDIT_SCHEMA).write.mode("append").parquet(lake.audit_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # The batch is audit rows: one per landed table, a handful per load.
        tables = [r["raw_table"].split(".", 1)[1] for r in
                  batch.where(F.col("status") == "loaded").select("raw_table").distinct().collect()]
        def failed(m: UnifiedModel, exc: BaseException) -> None:
            """A bad load of one model must not stop the others."""
            if on_gate_failure == "raise":
                raise exc
            log.error("refresh epoch %d: %s not published: %s", epoch_id, m.name, exc)
            kind = "gate_failed" if isinstance(exc, QualityGateError) else "failed"
            now = dt.datetime.now(dt.timezone.utc)
            (spark.createDataFrame([(m.name, epoch_id, kind, str(exc), now)], REFRESH_LOG_SCHEMA)
             .coalesce(1).write.mode("append").parquet(f"{lake.root}/_refresh_log"))

        def refresh_one(m: UnifiedModel) -> None:
            status = staleness(publisher, m)
            if not needs_refresh(status, m.target_lag):
                return   # a replayed batch: everything audited is published
            if overdue(status, m.target_lag):
                log.warning("refresh epoch %d: %s is past its target lag", epoch_id, m.name)
            try:
                res = publisher.publish(m, gate=gate)
            except Exception as exc:
                failed(m, exc)
                return
            log.info("refresh epoch %d: %s -> epoch %d (rebuilt %s)", epoch_id, m.name,
                     res.epoch, res.rebuilt)

        due = models_fed_by(tables, ms)
        if due and by_deadline:   # all models: a tighter one may get a load meanwhile
            from unilake.streaming.schedule import refresh_by_deadline
            by = {m.name: m for m in ms}
            for item in refresh_by_deadline(publisher, ms, gate=gate):
                if item.error is not None:
                    failed(by[item.model], item.error)
        elif due:   # models are independent: publish them side by side
            with ThreadPoolExecutor(max_workers=len(due)) as pool:
                list(pool.map(refresh_one, due))

    reader = spark.readStream.schema(AUDIT_SCHEMA).parquet(lake.audit_path)
    writer = reader.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        if trigger is None:
            bound = min(parse_lag(m.target_lag) for m in ms)
            trigger = f"{max(1, int(bound // 2))} seconds"
        writer = writer.trigger(processingTime=trigger)
    if not ledger:
        return writer.start()
    from unilake.streaming.freshness import FreshnessListener
    listener = FreshnessListener(publisher, ms)
    spark.streams.addListener(listener)
    query = writer.start()
    listener.query_id = str(query.id)
    return query
