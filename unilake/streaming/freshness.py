"""Measured freshness: seconds from a committed load to its publication.

One ledger file per published epoch of a model, under ``_freshness`` of the lake,
is created by whoever comes first (a refresh stream's listener after each
micro-batch, or :func:`record_freshness`); so each epoch is entered once, however
often a batch is replayed.  An epoch's entry names every load that became visible
with it: a source's loads after the version of the epoch before, up to its own.
Loads that a newer one replaced before they were published count as published
with that one.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from unilake.operators.unify import UnifiedModel
from unilake.plans.layers import Publisher
from unilake.session import list_dir, path_exists, write_text_atomic
from unilake.sources.landing import Lake
from unilake.streaming.refresh import model_inputs, parse_lag

log = logging.getLogger(__name__)

LEDGER_SCHEMA = ("model string, epoch long, source string, load_id long, row_count long, landed_at timestamp, "
                 "published_at timestamp, seconds double, target_lag double, within_lag boolean")


def ledger_path(lake: Lake) -> str:
    return f"{lake.root}/_freshness"


def entered_epochs(lake: Lake, model: UnifiedModel) -> set[int]:
    head = f"{model.name}-epoch="
    return {int(n[len(head):-len(".json")]) for n, is_dir in list_dir(lake.spark, ledger_path(lake))
            if not is_dir and n.startswith(head) and n.endswith(".json")}


def record_freshness(publisher: Publisher, models: Sequence[UnifiedModel]) -> int:
    """Enter every published epoch that the ledger lacks; returns how many."""
    lake, entered = publisher.lake, 0
    for m in models:
        done = entered_epochs(lake, m)
        for epoch in range(1, publisher.pointer(m).epoch + 1):
            if epoch in done:
                continue
            now = publisher.pointer(m, epoch)
            before = publisher.pointer(m, epoch - 1).versions if epoch > 1 else {}
            visible = F.lit(False)
            for source, raw in model_inputs(m).items():
                if source in now.versions:
                    visible |= (F.col("raw_table") == f"raw.{raw}") & F.col("load_id").between(
                        before.get(source, 0) + 1, now.versions[source])
            loads = lake.audit().where((F.col("status") == "loaded") & visible).select(
                "raw_table", "load_id", "row_count", F.col("landed_at").cast("double").alias("at")).distinct().collect()
            source_of = {f"raw.{raw}": source for source, raw in model_inputs(m).items()}
            lag = parse_lag(m.target_lag)
            lines = []
            for r in sorted(loads, key=lambda r: (r["raw_table"], r["load_id"])):
                seconds = now.published_at.timestamp() - r["at"]
                lines.append(json.dumps({
                    "model": m.name, "epoch": epoch, "source": source_of[r["raw_table"]], "load_id": r["load_id"],
                    "row_count": r["row_count"], "landed_at": r["at"], "published_at": now.published_at.timestamp(),
                    "seconds": seconds, "target_lag": lag, "within_lag": seconds <= lag}))
            try:
                write_text_atomic(lake.spark, f"{ledger_path(lake)}/{m.name}-epoch={epoch}.json", "\n".join(lines))
                entered += 1
            except FileExistsError:   # another driver or thread has entered it
                pass
    return entered


def freshness_ledger(lake: Lake) -> DataFrame:
    """One row per model, epoch and load that became visible with it."""
    if not path_exists(lake.spark, ledger_path(lake)):
        return lake.spark.createDataFrame([], LEDGER_SCHEMA)
    raw = LEDGER_SCHEMA.replace("_at timestamp", "_at double")
    # not the temporary siblings that a listener writes meanwhile
    return lake.spark.read.schema(raw).option("pathGlobFilter", "*.json").json(ledger_path(lake)).withColumns(
        {c: F.timestamp_seconds(c) for c in ("landed_at", "published_at")})


class FreshnessListener(StreamingQueryListener):
    """Enters what a refresh stream has published after each of its micro-batches."""

    def __init__(self, publisher: Publisher, models: Sequence[UnifiedModel]):
        self.publisher, self.models = publisher, list(models)
        self.query_id: str | None = None     # set once the stream has started

    def _record(self, query_id) -> None:
        if self.query_id is not None and str(query_id) != self.query_id:
            return   # another query of the session
        try:
            record_freshness(self.publisher, self.models)
        except Exception:   # the ledger must not disturb the stream; the next batch enters it
            log.exception("freshness not recorded")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._record(event.progress.id)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._record(event.id)
