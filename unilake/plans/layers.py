"""Layers and publication: raw -> staging -> intermediate.

* Layer routing: a model's custom schema name is used verbatim (trimmed),
  else the default schema.
* Staging is a view: recomputed from the newest audited raw load on every
  read, never stored.
* A unified model is published as one immutable version folder per source::

      intermediate/<model>/<source>/v=<load_id>/part-*.parquet
      intermediate/<model>/_pointer/epoch=<E>.json  (source -> version)

  plus a pointer.  Publishing rebuilds only the sources whose newest raw
  load differs from the version the pointer names, writes that version,
  runs the model's data tests on the candidate (new versions + unchanged
  ones), and only then writes the next pointer epoch: readers switch
  atomically, and a failed gate leaves them on the previous state.  A
  version folder that the pointer names is never rewritten, so replaying a
  load is a no-op.  The source tag is not stored; the read side adds it as a
  literal per branch, so a filter on the source drops whole branches.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unilake.functions.exprs import date_rejects, row_hash
from unilake.operators import quality
from unilake.operators.mapping import stage
from unilake.operators.unify import UnifiedModel, align
from unilake.plans.models import STAGING, UNIFIED
from unilake.session import list_dir, path_exists, read_text, write_text_atomic
from unilake.sources.landing import RAW_LAYER, Lake

log = logging.getLogger(__name__)

STAGING_LAYER = "staging"
ROW_HASH_COLUMN = "_row_hash"     # stored with each version, never shown by views
# of versions written with their rejected rows: a folder per flag, and the tests failed
REJECTED_COLUMN, REASONS_COLUMN = "rejected", "_rejected_by"
INTERMEDIATE_LAYER = "intermediate"


def layer_name(custom: str | None, default: str) -> str:
    """Custom schema used verbatim (trimmed), else the default schema."""
    return (default if custom is None else custom).strip()


@dataclass
class Pointer:
    epoch: int = 0
    versions: dict[str, int] = field(default_factory=dict)
    published_at: dt.datetime | None = None
    build_seconds: float | None = None      # what the publication took


@dataclass
class PublishResult:
    model: str
    epoch: int
    versions: dict[str, int]
    rebuilt: list[str]
    report: DataFrame | None = None
    # lenient staging only: "<source>.<field>" -> texts that did not parse as dates
    date_rejects: dict[str, int] = field(default_factory=dict)
    # keep_rejects only: source -> rows kept out of the version that was written
    rejected: dict[str, int] = field(default_factory=dict)


class Publisher:
    """Publishes unified models of a :class:`Lake` as versioned folders."""

    def __init__(self, lake: Lake, parallelism: int = 4, lenient_dates: bool = False,
                 keep_rejects: bool = False):
        """``keep_rejects``: rows that fail a not_null or accepted_values test, of
        the unified or its staging model, don't block the publication: they
        are kept beside the version with the tests they fail (see
        :func:`rejected_rows`), and the others are published.  One write does
        both.  ``lenient_dates``: malformed date text becomes NULL instead of failing
        the build; the rejects are counted on the same write job and returned
        in :attr:`PublishResult.date_rejects`."""
        self.lake = lake
        self.spark = lake.spark
        self.parallelism = max(1, parallelism)
        self.lenient_dates = lenient_dates
        self.keep_rejects = keep_rejects

    # --- paths -----------------------------------------------------------------
    def model_path(self, model: UnifiedModel) -> str:
        return f"{self.lake.layer_path(INTERMEDIATE_LAYER)}/{model.name}"

    def version_path(self, model: UnifiedModel, source: str, version: int) -> str:
        return f"{self.model_path(model)}/{source}/v={version}"

    def pointer_root(self, model: UnifiedModel) -> str:
        return f"{self.model_path(model)}/_pointer"

    def _committed(self, path: str) -> bool:
        return path_exists(self.spark, f"{path}/_SUCCESS")

    # --- pointer -----------------------------------------------------------------
    def pointer(self, model: UnifiedModel, epoch: int | None = None) -> Pointer:
        """The newest pointer epoch, or a given one (one small file read on the
        driver through the file system; no Spark job)."""
        root = self.pointer_root(model)
        epochs = sorted(int(n[len("epoch="):-len(".json")]) for n, is_dir in
                        list_dir(self.spark, root)
                        if not is_dir and n.startswith("epoch=") and n.endswith(".json"))
        if epoch is not None:
            epochs = [e for e in epochs if e == epoch]
        if not epochs:
            return Pointer()
        doc = json.loads(read_text(self.spark, f"{root}/epoch={epochs[-1]}.json"))
        return Pointer(int(doc["epoch"]), {k: int(v) for k, v in doc["versions"].items()},
                       dt.datetime.fromisoformat(doc["published_at"]), doc.get("build_seconds"))

    def _write_pointer(self, model: UnifiedModel, epoch: int, versions: Mapping[str, int],
                       started: dt.datetime) -> None:
        """Commit a new epoch: written whole then renamed into place, and never
        over an existing epoch (two publishers cannot both commit epoch N)."""
        now = self.lake.clock()
        doc = {"epoch": epoch, "versions": dict(sorted(versions.items())), "published_at": now.isoformat(),
               "build_seconds": (now - started).total_seconds()}
        write_text_atomic(self.spark, f"{self.pointer_root(model)}/epoch={epoch}.json",
                          json.dumps(doc))

    # --- reading -----------------------------------------------------------------
    def _has_rejects(self, path: str) -> bool:
        """Whether a version was written with its rejected rows beside it."""
        return any(n.startswith(f"{REJECTED_COLUMN}=") for n, is_dir in list_dir(self.spark, path) if is_dir)

    def stored_rows(self, path: str, rejected: bool = False) -> DataFrame:
        """A version's rows; the flag is a folder, so only its files are read."""
        df = self.spark.read.parquet(path)
        if REJECTED_COLUMN not in df.columns:
            return df.limit(0) if rejected else df
        df = df.where(F.col(REJECTED_COLUMN) == int(rejected)).drop(REJECTED_COLUMN)
        return df if rejected else df.drop(REASONS_COLUMN)

    def read_versions(self, model: UnifiedModel, versions: Mapping[str, int],
                      with_hash: bool = False) -> DataFrame:
        """Union of the given per-source versions, source tag as a literal.
        ``with_hash`` adds the stored content hash (computed when missing)."""
        cols = [f.name for f in model.schema.fields]
        parts = []
        for b in model.branches:
            if b.source_system not in versions:
                continue
            df = self.stored_rows(self.version_path(model, b.source_system, versions[b.source_system]))
            out = cols
            if with_hash:
                if ROW_HASH_COLUMN not in df.columns:
                    df = df.withColumn(ROW_HASH_COLUMN, row_hash(self._hashed_columns(model)))
                out = cols + [ROW_HASH_COLUMN]
            parts.append(df.withColumn(model.source_column, F.lit(b.source_system))
                         .select(*out))
        if not parts:
            raise FileNotFoundError(f"{model.name} has no published version")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def read(self, model: UnifiedModel | str) -> DataFrame:
        """The published model (as the current pointer names it)."""
        m = UNIFIED[model] if isinstance(model, str) else model
        return self.read_versions(m, self.pointer(m).versions)

    def view_sql(self, model: UnifiedModel, versions: Mapping[str, int]) -> str:
        cols = [f.name for f in model.schema.fields]
        branches = []
        for b in model.branches:
            if b.source_system not in versions:
                continue
            sel = ", ".join(f"'{b.source_system}' AS {c}" if c == model.source_column else c
                            for c in cols)
            path = self.version_path(model, b.source_system, versions[b.source_system])
            good = f" WHERE {REJECTED_COLUMN} = 0" if self._has_rejects(path) else ""
            branches.append(f"SELECT {sel} FROM parquet.`{path}`{good}")
        return "\nUNION ALL\n".join(branches)

    def register_view(self, model: UnifiedModel, versions: Mapping[str, int]) -> None:
        """``CREATE OR REPLACE VIEW intermediate.<model>`` over the versions,
        with the model's table and column comments."""
        self.lake.create_view(layer_name(model.layer, INTERMEDIATE_LAYER), model.name,
                              self.view_sql(model, versions), model.comment,
                              [(f.name, f.metadata.get("comment", "")) for f in model.schema.fields])

    # --- data tests ---------------------------------------------------------------
    def _check_counts_path(self, version_path: str) -> str:
        return f"{version_path}/_row_checks.json"     # hidden from parquet readers

    def _write_check_counts(self, version_path: str, counts: Mapping[str, int]) -> None:
        write_text_atomic(self.spark, self._check_counts_path(version_path),
                          json.dumps(dict(counts)))

    def _read_check_counts(self, version_path: str) -> dict[str, int] | None:
        text = read_text(self.spark, self._check_counts_path(version_path))
        return json.loads(text) if text else None

    @staticmethod
    def _source_scoped_unique(model: UnifiedModel) -> list:
        """unique checks on a key that hashes the source tag: keys of different
        sources cannot collide, so per-source counts add up to the model's."""
        if model.source_column not in model.key_parts:
            return []
        return [c for c in model.tests if c.kind == "unique" and c.column == model.key_name]

    def _staging_counts(self, staged: DataFrame, staging_name: str,
                        observed: Mapping[str, int] | None = None,
                        unique: Mapping[str, int] | None = None) -> dict[str, int]:
        """Failures of a staging model's tests, keyed ``<model>|<kind>:<column>``;
        counted now but for those that are given."""
        tests = STAGING[staging_name].tests
        aggs = quality.row_check_aggs(tests)
        counts = dict(observed if observed is not None else
                      staged.agg(*aggs).first().asDict() if aggs else {})
        if unique is None:
            unique = {c.column: quality.unique_failures(staged, c.column) for c in tests if c.kind == "unique"}
        counts |= {f"unique:{c}": n for c, n in unique.items()}
        return {f"{staging_name}|{k}": int(v) for k, v in counts.items()}

    def _version_counts(self, model: UnifiedModel, branch, version: int) -> dict[str, int]:
        """Test failures of one version: stored with it, else counted now."""
        path = self.version_path(model, branch.source_system, version)
        counts = self._read_check_counts(path)
        if counts is not None and (not STAGING[branch.staged].tests or any("|" in k for k in counts)):
            return counts
        part = self.stored_rows(path).withColumn(
            model.source_column, F.lit(branch.source_system))
        aggs = quality.row_check_aggs(model.tests)
        counts = part.agg(*aggs).first().asDict() if aggs else {}
        for c in self._source_scoped_unique(model):
            counts[f"unique:{c.column}"] = quality.unique_failures(part, c.column)
        return counts | self._staging_counts(self.staged(branch.staged, version), branch.staged)

    def check(self, model: UnifiedModel, versions: Mapping[str, int]) -> DataFrame:
        """Data tests of a candidate (the given per-source versions): those of
        the staging models it reads, source by source, and its own.

        Counts were taken when each version was written, and unique counts of
        a source-tagged key per version; they are summed here, so an unchanged
        source is not read again.  A version without stored counts is checked
        once now.  Any other unique check needs every version's values
        together: it runs on the union.
        """
        scoped = self._source_scoped_unique(model)
        totals: dict[str, int] = {}
        rows = []
        for b in model.branches:
            if b.source_system not in versions:
                continue
            counts = self._version_counts(model, b, versions[b.source_system])
            for k, n in counts.items():
                if "|" not in k:
                    totals[k] = totals.get(k, 0) + int(n)
            rows += [(b.staged, c.column, c.kind, int(counts.get(f"{b.staged}|{c.kind}:{c.column}", 0)))
                     for c in STAGING[b.staged].tests]
        rows += quality.report_rows(model.name, model.tests, totals)
        rows += [(model.name, c.column, "unique", int(totals.get(f"unique:{c.column}", 0)))
                 for c in scoped]
        rest = [c for c in model.tests if c.kind == "unique" and c not in scoped]
        if rest:
            candidate = self.read_versions(model, versions)
            rows += quality.unique_checks(candidate, model.name, rest)
        return (self.spark.createDataFrame(rows, quality.REPORT_SCHEMA)
                .withColumn("passed", F.col("failures") == 0))

    @staticmethod
    def _hashed_columns(model: UnifiedModel) -> list[str]:
        return [c for c in model.content_columns if c not in (model.key_name, model.source_column)]

    # --- retention ------------------------------------------------------------------
    def vacuum(self, model: UnifiedModel | str, keep_epochs: int = 2) -> list[str]:
        """Delete version folders that none of the newest ``keep_epochs``
        pointer epochs names (older epochs lose their time travel).  A
        version newer than every kept one is left alone: a publish may be
        writing it.  Returns the deleted paths."""
        from unilake.session import delete_path
        m = UNIFIED[model] if isinstance(model, str) else model
        root = self.pointer_root(m)
        epochs = sorted(int(n[len("epoch="):-len(".json")]) for n, is_dir in
                        list_dir(self.spark, root)
                        if not is_dir and n.startswith("epoch=") and n.endswith(".json"))
        kept = epochs[-max(1, keep_epochs):]
        referenced: dict[str, set[int]] = {}
        for e in kept:
            for s, v in self.pointer(m, e).versions.items():
                referenced.setdefault(s, set()).add(v)
        deleted = []
        for b in m.branches:
            s = b.source_system
            refs = referenced.get(s, set())
            for entry, is_dir in list_dir(self.spark, f"{self.model_path(m)}/{s}"):
                if not (is_dir and entry.startswith("v=")):
                    continue
                v = int(entry.split("=", 1)[1])
                if v in refs or (refs and v > max(refs)) or not refs:
                    continue
                path = self.version_path(m, s, v)
                delete_path(self.spark, path)
                deleted.append(path)
        return deleted

    # --- building ----------------------------------------------------------------
    def staged(self, staging_name: str, load_id: int,
               observation: Observation | None = None) -> DataFrame:
        """A staging model over one raw load.  With lenient dates and an
        ``observation``, the date rejects are observed on the raw rows."""
        m = STAGING[staging_name]
        raw = self.lake.read_raw(m.raw_name, load_id)
        if self.lenient_dates and observation is not None:
            dates = [f for f in m.fields if f.cast == "date"]
            if dates:
                raw = raw.observe(observation, *[
                    F.sum(date_rejects(F.col(f.source or f.name))).alias(f.name) for f in dates])
        return stage(raw, m, lenient_dates=self.lenient_dates)

    def publish(self, model: UnifiedModel | str, gate: bool = True,
                sources: Sequence[str] | None = None,
                register: bool = True) -> PublishResult:
        """Bring a published model up to the newest audited raw loads."""
        m = UNIFIED[model] if isinstance(model, str) else model
        started = self.lake.clock()
        loads = self.lake.current_loads()
        ptr = self.pointer(m)
        versions = dict(ptr.versions)
        rebuilt = []
        todo = []
        for b in m.branches:
            if sources is not None and b.source_system not in sources:
                continue
            raw_name = STAGING[b.staged].raw_name
            if raw_name not in loads:
                log.warning("%s: no audited load of %s yet", m.name, raw_name)
                continue
            load_id, landed_at, _rows = loads[raw_name]
            if versions.get(b.source_system) == load_id:
                continue
            path = self.version_path(m, b.source_system, load_id)
            # (a version that a gate refused may have been written the other way)
            if not self._committed(path) or self._has_rejects(path) != self.keep_rejects:
                todo.append((b, load_id, landed_at, path))
            versions[b.source_system] = load_id
            rebuilt.append(b.source_system)

        rejects: dict[str, int] = {}
        kept_out: dict[str, int] = {}

        def marked(staged: DataFrame, b, stamp) -> DataFrame:
            """Aligned rows with the tests they fail and the flag they are stored by."""
            why = quality.failed_checks(b.staged, STAGING[b.staged].tests).alias(REASONS_COLUMN)
            rows = align(staged, b, m, loaded_at=stamp, extra=[why])
            rows = rows.withColumn(REASONS_COLUMN, F.concat(REASONS_COLUMN, quality.failed_checks(m.name, m.tests)))
            return rows.withColumn(REJECTED_COLUMN, (F.size(REASONS_COLUMN) > 0).cast("int"))

        def write_apart(item) -> None:
            """Like ``write``, with the offending rows beside the version: the row
            checks hold for what is published, unique checks are taken over it."""
            b, load_id, landed_at, path = item
            rows = marked(self.staged(b.staged, load_id), b, F.lit(landed_at).cast("timestamp"))
            good = rows.where(F.col(REJECTED_COLUMN) == 0)
            raw = self.staged(b.staged, load_id).where(F.size(
                quality.failed_checks(b.staged, STAGING[b.staged].tests)) == 0)
            ids = [c.column for c in STAGING[b.staged].tests if c.kind == "unique"]
            scoped = [c.column for c in self._source_scoped_unique(m)]
            obs = Observation(f"rejects_{m.name}_{b.source_system}_{uuid.uuid4().hex[:8]}")
            with ThreadPoolExecutor(max_workers=1 + len(scoped) + len(ids)) as inner:
                own = {c: inner.submit(quality.unique_failures, good, c) for c in scoped}
                below = {c: inner.submit(quality.unique_failures, raw, c) for c in ids}
                out = rows.withColumn(ROW_HASH_COLUMN, row_hash(self._hashed_columns(m))).drop(m.source_column)
                (out.observe(obs, F.coalesce(F.sum(REJECTED_COLUMN), F.lit(0)).alias("n"))
                    .write.mode("overwrite").partitionBy(REJECTED_COLUMN).parquet(path))
                kept_out[b.source_system] = int(obs.get["n"])
                counts = {f"{c.kind}:{c.column}": 0 for c in m.tests if c.kind != "unique"}
                counts |= {f"unique:{c}": f.result() for c, f in own.items()}
                counts |= self._staging_counts(raw, b.staged, {
                    f"{c.kind}:{c.column}": 0 for c in STAGING[b.staged].tests if c.kind != "unique"},
                    {c: f.result() for c, f in below.items()})
            self._write_check_counts(path, counts)

        def write(item) -> None:
            b, load_id, landed_at, path = item
            stamp = F.lit(landed_at).cast("timestamp")
            date_obs = Observation(f"dates_{m.name}_{b.source_system}_{uuid.uuid4().hex[:8]}")
            staged = self.staged(b.staged, load_id, date_obs)
            stage_aggs = quality.row_check_aggs(STAGING[b.staged].tests)
            stage_obs = Observation(f"staged_{b.staged}_{uuid.uuid4().hex[:8]}")
            df = align(staged.observe(stage_obs, *stage_aggs) if stage_aggs else staged,
                       b, m, loaded_at=stamp)
            aggs = quality.row_check_aggs(m.tests)
            obs = Observation(f"checks_{m.name}_{b.source_system}_{uuid.uuid4().hex[:8]}")
            scoped = self._source_scoped_unique(m)
            # the row's content hash is stored with the version (hidden from
            # readers): change sets between epochs then read key + hash only
            df = df.withColumn(ROW_HASH_COLUMN, row_hash(self._hashed_columns(m)))
            ids = [c.column for c in STAGING[b.staged].tests if c.kind == "unique"]
            with ThreadPoolExecutor(max_workers=1 + len(scoped) + len(ids)) as inner:
                # unique checks of the source's key and of its staging model run
                # beside the write (they read only the key's input columns);
                # row-check counts ride along with the write as observed metrics
                raw = self.staged(b.staged, load_id)
                staged_uniq = {c: inner.submit(quality.unique_failures, raw, c) for c in ids}
                plain = align(raw, b, m, loaded_at=stamp)
                uniq = {c.column: inner.submit(quality.unique_failures, plain, c.column)
                        for c in scoped}
                out = df.observe(obs, *aggs) if aggs else df
                # only an uncommitted (failed) attempt can exist at this path
                out.drop(m.source_column).write.mode("overwrite").parquet(path)
                counts = {k: int(v) for k, v in obs.get.items()} if aggs else {}
                counts.update({f"unique:{c}": f.result() for c, f in uniq.items()})
                counts |= self._staging_counts(
                    raw, b.staged, {k: int(v) for k, v in stage_obs.get.items()} if stage_aggs else {},
                    {c: f.result() for c, f in staged_uniq.items()})
            if self.lenient_dates and any(f.cast == "date" for f in STAGING[b.staged].fields):
                for k, v in date_obs.get.items():
                    rejects[f"{b.source_system}.{k}"] = int(v or 0)
                    # a text given up as a date is reported here, not by not_null
                    test = f"{b.staged}|not_null:{k}"
                    if test in counts:
                        counts[test] -= int(v or 0)
                    if v:
                        log.warning("%s: %d %s texts of source %s are not dates (NULL)",
                                    m.name, v, k, b.source_system)
            self._write_check_counts(path, counts)

        if todo:   # sources are independent jobs: build their versions concurrently
            with ThreadPoolExecutor(max_workers=min(self.parallelism, len(todo))) as pool:
                list(pool.map(write_apart if self.keep_rejects else write, todo))
        if versions == ptr.versions:
            if register and versions:   # a new session, or a driver lost before its view
                self.register_view(m, versions)
            return PublishResult(m.name, ptr.epoch, versions, [])
        report = None
        if gate:
            report = self.check(m, versions)
            quality.gate(report)
        epoch = ptr.epoch + 1
        self._write_pointer(m, epoch, versions, started)
        if register:
            self.register_view(m, versions)
        log.info("published %s epoch %d: %s (rebuilt %s)", m.name, epoch, versions, rebuilt)
        return PublishResult(m.name, epoch, versions, rebuilt, report, rejects, kept_out)


def rejected_rows(publisher: Publisher, model: UnifiedModel | str) -> DataFrame:
    """Rows kept beside the published versions of a model: the whole row, the
    model and check that it fails, one row per failed check."""
    m = UNIFIED[model] if isinstance(model, str) else model
    parts = []
    for source, version in publisher.pointer(m).versions.items():
        path = publisher.version_path(m, source, version)
        if not publisher._has_rejects(path):
            continue
        rows = publisher.stored_rows(path, rejected=True).withColumn(m.source_column, F.lit(source))
        why = F.explode(REASONS_COLUMN).alias("why")
        parts.append(rows.select(*[f.name for f in m.schema.fields], why).withColumn("why", F.split("why", r"[|:]")).select(
            "*", F.get("why", F.lit(0)).alias("model"), F.get("why", F.lit(1)).alias("check_name"),
            F.get("why", F.lit(2)).alias("column_name")).drop("why"))
    if not parts:
        names = T.StructType([*m.schema.fields, *[T.StructField(n, T.StringType()) for n in ("model", "check_name", "column_name")]])
        return publisher.spark.createDataFrame([], names)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def published_changes(publisher: Publisher, model: UnifiedModel | str, from_epoch: int,
                      to_epoch: int | None = None, payload: bool = False) -> DataFrame:
    """Inserts / updates / deletes between two published epochs of a model.

    Versions are immutable per source, so a source whose version did not
    change between the epochs has no changes and is not read at all; only
    the changed sources are diffed (each with one grouping shuffle).  The
    key hashes the source tag, so per-source diffs never overlap.  Epoch 0 is
    the empty state before the first.  ``payload`` adds ``new_row``, the whole
    new row of inserts and updates; only changed rows' content is moved for it.
    """
    from unilake.operators.change_set import change_set
    m = UNIFIED[model] if isinstance(model, str) else model
    old = publisher.pointer(m, from_epoch).versions
    new = publisher.pointer(m, to_epoch).versions
    names = [f.name for f in m.schema.fields]
    compare = [c for c in m.content_columns if c not in (m.key_name, m.source_column)]
    key = [m.source_column, m.key_name]
    row = F.struct(*names).alias("new_row")
    nothing = F.lit(None).cast(m.schema).alias("new_row")
    parts = []
    for b in m.branches:
        s = b.source_system
        if old.get(s) == new.get(s):
            continue
        o = publisher.read_versions(m, {s: old[s]}, with_hash=True) if s in old else None
        n = publisher.read_versions(m, {s: new[s]}, with_hash=True) if s in new else None
        if o is None or n is None:
            kind, side = ("insert", n) if o is None else ("delete", o)
            part = side.select(*key, F.lit(kind).alias("change_type"),
                               *([row if o is None else nothing] if payload else []))
        else:   # stored hashes: only key + hash columns are read
            part = change_set(o, n, key, compare, hash_column=ROW_HASH_COLUMN)
            if payload:
                part = part.join(n.select(m.key_name, row), m.key_name, "left").select(
                    *key, "change_type", "new_row")
        parts.append(part)
    if not parts:
        empty = T.StructType([m.schema[m.source_column], m.schema[m.key_name], T.StructField("change_type", T.StringType()),
                              *([T.StructField("new_row", m.schema)] if payload else [])])
        return publisher.spark.createDataFrame([], empty)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def register_raw_views(lake: Lake) -> dict[str, int]:
    """``raw.<table>`` views over each table's newest audited load."""
    return lake.register_raw_views()


def register_missing_staging(lake: Lake) -> list[str]:
    """Create the persistent staging views that landed tables still lack (called
    after every landing).  A table whose columns don't fit its staging model
    gets none and is logged: landing takes whatever comes."""
    schema = f"{lake.namespace}{STAGING_LAYER}"
    done = []
    for name, m in STAGING.items():
        raw = f"{lake.namespace}{RAW_LAYER}.{m.raw_name}"
        layer = layer_name(m.layer, schema)
        if lake.spark.catalog.tableExists(f"{layer}.{name}") or not lake.spark.catalog.tableExists(raw):
            continue
        try:
            _staging_view(lake, name)
            done.append(name)
        except AnalysisException as exc:
            log.warning("no staging view %s: %s", name, exc)
    return done


def _staging_view(lake: Lake, name: str) -> None:
    from unilake.operators.mapping import staging_sql
    m = STAGING[name]
    lake.create_view(layer_name(m.layer, STAGING_LAYER), name,
                     staging_sql(m, f"{lake.namespace}{RAW_LAYER}.{m.raw_name}"), m.comment,
                     [(f.name, f.comment) for f in m.fields], evolving=True)


def register_staging_views(lake: Lake, persistent: bool = False) -> list[str]:
    """Staging views over the current raw loads.

    ``persistent=False``: session views ``stg_*`` (re-run after a load).
    ``persistent=True``: ``CREATE OR REPLACE VIEW staging.stg_* AS SELECT ...
    FROM raw.<table>`` -- SQL views over the raw views, which every landing
    repoints, so the staging layer shows a new load at once.  They take over
    the types of the load they read: a load that widens a column is read
    through the view that was there before.
    """
    loads = lake.current_loads()
    done = []
    if persistent:
        lake.register_raw_views()
    for name, m in STAGING.items():
        if m.raw_name not in loads:
            continue
        if persistent:
            _staging_view(lake, name)
        else:
            stage(lake.read_raw(m.raw_name, loads[m.raw_name][0]), m).createOrReplaceTempView(name)
        done.append(name)
    return done
