"""Change feed: each published epoch's changes, handed to consumers exactly once.

The pointer epochs of a model are a stream of small files that are only ever
added.  A Structured Streaming query reads them one by one; its checkpoint
remembers which ones were handed over.  An epoch's changes are the differences
between the versions it names and those of the epoch before (see
:func:`unilake.plans.layers.published_changes`), inserts and updates with the new
row.  A micro-batch that is replayed hands over the same epoch with the same
changes: sinks keyed by the epoch (both below) write it once.

* :func:`start_change_log`: every epoch's changes as one folder of a log.
* :func:`start_copy`: a consumer's own copy of the model, epoch by epoch.  Its rows
  equal the published ones but for the load stamp, which is no content: a copied
  row has that of the epoch which last changed it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from unilake.operators.unify import UnifiedModel
from unilake.plans.layers import Publisher, published_changes
from unilake.plans.models import UNIFIED
from unilake.session import delete_path, list_dir, path_exists

POINTER_SCHEMA = T.StructType([T.StructField("epoch", T.LongType()),
                               T.StructField("versions", T.MapType(T.StringType(), T.LongType())),
                               T.StructField("published_at", T.StringType())])
Handler = Callable[[DataFrame, int], None]


def epoch_changes(publisher: Publisher, model: UnifiedModel, epoch: int) -> DataFrame:
    """Changes that an epoch brought: key, change_type, new_row (NULL for deletes)."""
    return published_changes(publisher, model, epoch - 1, epoch, payload=True)


def start_change_feed(publisher: Publisher, model: UnifiedModel | str, handler: Handler, checkpoint: str,
                      available_now: bool = False, trigger: str = "5 seconds",
                      query_name: str | None = None) -> StreamingQuery:
    """Call ``handler(changes, epoch)`` for every published epoch, in order.

    An epoch counts as handed over when the handler has returned; after a
    failure before that it is handed over again, with the same changes.
    """
    m = UNIFIED[model] if isinstance(model, str) else model
    root = publisher.pointer_root(m)
    if not path_exists(publisher.spark, root):
        raise FileNotFoundError(f"{m.name} has no published epoch yet")

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        # one pointer file per micro-batch: a single row
        for r in batch.select("epoch").orderBy("epoch").collect():
            handler(epoch_changes(publisher, m, int(r["epoch"])), int(r["epoch"]))

    # pointer files take their names whole, so none is read half-written
    reader = publisher.spark.readStream.schema(POINTER_SCHEMA).option("maxFilesPerTrigger", 1) \
        .option("pathGlobFilter", "epoch=*.json").json(root)
    writer = reader.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def _epochs(spark, path: str) -> list[int]:
    """Epochs whose folder is complete."""
    return sorted(int(n[len("epoch="):]) for n, is_dir in list_dir(spark, path)
                  if is_dir and n.startswith("epoch=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def start_change_log(publisher: Publisher, model: UnifiedModel | str, path: str, **options) -> StreamingQuery:
    """Keep every epoch's changes under ``path/epoch=<N>``; a replayed epoch
    replaces its own folder."""
    def write(changes: DataFrame, epoch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return start_change_feed(publisher, model, write, f"{path}/_checkpoint", **options)


def read_change_log(publisher: Publisher, path: str) -> DataFrame:
    """All changes kept by :func:`start_change_log`, with their epoch."""
    return publisher.spark.read.option("basePath", path).parquet(
        *[f"{path}/epoch={e}" for e in _epochs(publisher.spark, path)])


def apply_changes(copy: DataFrame | None, changes: DataFrame, model: UnifiedModel) -> DataFrame:
    """A copy of the model with one epoch's changes: changed keys leave, new rows
    enter.  The anti join moves keys and rows once; keys are unique, so no key is hot."""
    names = [f.name for f in model.schema.fields]
    new = changes.where("change_type <> 'delete'").select("new_row.*").select(*names)
    if copy is None:
        return new
    gone = changes.where("change_type <> 'insert'").select(model.key_name)
    return copy.join(gone, model.key_name, "left_anti").select(*names).unionByName(new)


def read_copy(publisher: Publisher, path: str) -> DataFrame:
    """The newest epoch of a consumer's copy."""
    epochs = _epochs(publisher.spark, path)
    if not epochs:
        raise FileNotFoundError(f"{path} holds no epoch yet")
    return publisher.spark.read.parquet(f"{path}/epoch={epochs[-1]}")


def start_copy(publisher: Publisher, model: UnifiedModel | str, path: str, keep: int = 2, **options) -> StreamingQuery:
    """Keep a copy of the model under ``path``, built from the feed alone.

    Epoch N of the copy is written from its epoch N - 1 and the changes of N, into
    a folder of its own: a replayed epoch writes the same rows again.  Only the
    newest ``keep`` epochs are kept.
    """
    m = UNIFIED[model] if isinstance(model, str) else model

    def write(changes: DataFrame, epoch: int) -> None:
        spark = publisher.spark
        before = None
        if epoch > 1:
            if epoch - 1 not in _epochs(spark, path):
                raise FileNotFoundError(f"{path} lacks epoch {epoch - 1}, which epoch {epoch} builds on")
            before = spark.read.parquet(f"{path}/epoch={epoch - 1}")
        apply_changes(before, changes, m).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        for e in _epochs(spark, path):
            if e <= epoch - max(2, keep):
                delete_path(spark, f"{path}/epoch={e}")

    return start_change_feed(publisher, m, write, f"{path}/_checkpoint", **options)

