"""Raw layer: land source tables unchanged as versioned snapshots, with an audit.

Layout under the lake root (a shared folder; see :func:`unilake.session.work_root`)::

    raw/raw_<source>__<table>/load_id=<N>/part-*.parquet   one folder per load
    raw/_loads/load_id=<N>.json                            who reserved the id, and when
    raw/_audit/part-*.parquet                              one row per landed table

A load is *full replace*: the newest audited load of a table is the table;
older loads stay readable by id.  Writing a new folder per load (instead of
overwriting in place) means a reader never sees a half-written table, a
failed write leaves the previous load current, and the schema may change
between loads.  The audit row is appended last, after every table of the
load is written: it is the commit marker, and everything downstream (views,
refresh) reads only audited loads.  Row counts come from an ``Observation``
on the write itself -- no second scan -- and must equal the counts in the
written files' footers, or the load raises and is not audited.

Landers may run side by side.  Each reserves its load id, by creating a file
that only one can create, before it writes any data; its audit rows are moved
in as one finished file.  Of two loads of one table the higher id is current,
whichever commits last.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampType)

from unilake.session import (delete_path, fresh_dir, list_dir, move_into, path_exists, read_text, work_root,
                             write_text_atomic)
from unilake.sources.drift import AS_LANDED, Drift, DriftPolicy, compare, reconciled

log = logging.getLogger(__name__)

RAW_LAYER = "raw"

# Hadoop-style hidden entries (_SUCCESS, _temporary, .crc, _audit) are never tables.
DEFAULT_IGNORE = r"^[_.]"

AUDIT_SCHEMA = StructType([
    StructField("raw_table", StringType(), False),      # raw.raw_<source>__<table>
    StructField("source", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("load_id", LongType(), False),
    StructField("row_count", LongType(), True),
    StructField("status", StringType(), False),          # loaded | missing | rejected
    StructField("landed_at", TimestampType(), False),
    StructField("path", StringType(), True),
    StructField("drift", StringType(), True),            # columns unlike the known schema
])


class LoadCountError(RuntimeError):
    """The files of a load don't hold the rows that were written."""


def raw_table_name(source: str, table: str) -> str:
    """Physical raw table name: ``raw_<source>__<table>``, lower-cased."""
    return f"raw_{source}__{table}".lower()


def result_key(source: str, table: str) -> str:
    """Key reported for a landed table: ``raw.raw_<source>__<table>``."""
    return f"{RAW_LAYER}.{raw_table_name(source, table)}"


def list_tables(spark: SparkSession, source_root: str, ignore: str = DEFAULT_IGNORE) -> dict[str, str]:
    """Tables of a source (name -> path): its child datasets, which are folders
    and ``<name>.parquet`` files, minus internal entries matching ``ignore``.
    Other files are no tables and are left out with a log line."""
    out: dict[str, str] = {}
    for name, is_dir in list_dir(spark, source_root):
        if ignore and re.search(ignore, name):
            continue
        if not (is_dir or name.endswith(".parquet")):
            log.warning("%s/%s is no dataset; left out", source_root, name)
            continue
        table = name.removesuffix(".parquet")
        if table in out:
            raise ValueError(f"{source_root}: two datasets are named {table}")
        out[table] = f"{source_root.rstrip('/')}/{name}"
    return out


def read_source(spark: SparkSession, source_root: str,
                ignore: str = DEFAULT_IGNORE) -> dict[str, DataFrame]:
    """Full scan of every table of a source (no filter, no incremental bound)."""
    return {table: spark.read.parquet(path)
            for table, path in list_tables(spark, source_root, ignore).items()}


CATALOG_PREFIX = "catalog:"
_NAMESPACE_LOCK = threading.Lock()
_VIEW_LOCK = threading.Lock()


def read_catalog_source(spark: SparkSession, database: str,
                        ignore: str = DEFAULT_IGNORE) -> dict[str, DataFrame]:
    """Every table of a catalog database (``spark.catalog.listTables``),
    minus internal ones matching ``ignore``; full scans, no filter."""
    pat = re.compile(ignore) if ignore else None
    return {t.name: spark.table(f"{database}.{t.name}")
            for t in spark.catalog.listTables(database)
            if not t.isTemporary and not (pat and pat.search(t.name))}


@dataclass
class Lake:
    """A lake rooted at a shared folder: raw loads, audit, published models."""

    spark: SparkSession
    root: str | None = None
    parallelism: int = 4          # independent table writes submitted at once
    namespace: str = ""           # prefix of this lake's schemas in the catalog
    after_commit: Sequence[Callable[[Lake], object]] | None = None   # default: missing staging views
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc)

    def __post_init__(self) -> None:
        self.root = (self.root or f"{work_root(self.spark)}/lake").rstrip("/")
        self._footers: SparkSession | None = None
        if self.after_commit is None:
            from unilake.plans.layers import register_missing_staging   # the layer above
            self.after_commit = (register_missing_staging,)

    # --- paths ---------------------------------------------------------------
    def layer_path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def raw_path(self, raw_name: str, load_id: int | None = None) -> str:
        base = f"{self.layer_path(RAW_LAYER)}/{raw_name}"
        return base if load_id is None else f"{base}/load_id={load_id}"

    @property
    def audit_path(self) -> str:
        return f"{self.layer_path(RAW_LAYER)}/_audit"

    def reservation_path(self, load_id: int) -> str:
        return f"{self.layer_path(RAW_LAYER)}/_loads/load_id={load_id}.json"

    # --- namespaces ----------------------------------------------------------
    def ensure_namespace(self, layer: str) -> str:
        """The layer's schema, created inside the lake (never in the default
        local warehouse folder) when absent; serialised, as publishes of
        several models may run side by side.  A schema that belongs to another
        lake is refused: lakes that share a catalog need namespaces."""
        schema = f"{self.namespace}{layer}"

        def plain(path: str) -> str:
            return re.sub(r"^file:/+", "/", path).rstrip("/")

        with _NAMESPACE_LOCK:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} "
                           f"LOCATION '{self.layer_path(layer)}'")
            at = self.spark.catalog.getDatabase(schema).locationUri
        if plain(at) != plain(self.layer_path(layer)):
            raise ValueError(f"schema {schema} belongs to {at}; give the lake at "
                             f"{self.root} a namespace of its own")
        return schema

    def create_view(self, layer: str, name: str, sql: str, comment: str = "",
                    columns: Sequence[tuple[str, str]] = (), evolving: bool = False) -> None:
        """``CREATE OR REPLACE VIEW`` with its comments (shown by DESCRIBE).

        An ``evolving`` view takes over the types that the relations below it
        have when it is read; any other casts them back to those it was
        created with."""
        def q(text: str) -> str:
            return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

        schema = self.ensure_namespace(layer)
        cols = ", ".join(f"`{c}`" + (f" COMMENT {q(said)}" if said else "") for c, said in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name}" + (f" ({cols})" if cols else "")
                       + (f" COMMENT {q(comment)}" if comment else "")
                       + (" WITH SCHEMA TYPE EVOLUTION" if evolving else "") + " AS " + sql)

    def register_raw_views(self) -> dict[str, int]:
        """``raw.<table>`` views over each table's newest audited load."""
        with _VIEW_LOCK:   # the loads are read inside: no lander restores an older view
            loads = self.current_loads()
            for name, (load_id, landed_at, rows) in loads.items():
                self.create_view(RAW_LAYER, name, f"SELECT * FROM parquet.`{self.raw_path(name, load_id)}`",
                                 f"Load {load_id}, landed {landed_at:%Y-%m-%d %H:%M:%S} UTC, {rows} rows")
        return {n: v[0] for n, v in loads.items()}

    def null_counts(self, raw_name: str, load_id: int | None = None) -> dict[str, int]:
        """NULLs per column of a load, as observed while it was written."""
        load_id = self.current_loads()[raw_name][0] if load_id is None else load_id
        return json.loads(read_text(self.spark, f"{self.raw_path(raw_name, load_id)}/_nulls.json") or "{}")

    # --- audit ---------------------------------------------------------------
    def audit(self) -> DataFrame:
        if not path_exists(self.spark, self.audit_path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.audit_path)

    def reserved_ids(self) -> list[int]:
        """Load ids that some lander has reserved, audited or not."""
        names = [n for n, is_dir in list_dir(self.spark, f"{self.layer_path(RAW_LAYER)}/_loads") if not is_dir]
        return sorted(int(n[len("load_id="):-len(".json")]) for n in names
                      if n.startswith("load_id=") and n.endswith(".json"))

    def next_load_id(self) -> int:
        row = self.audit().agg(F.max("load_id").alias("m")).first()
        return max([int(row["m"] or 0), *self.reserved_ids()]) + 1

    def reserve(self, load_id: int | None = None, take_over: bool = False) -> tuple[int, str]:
        """Reserve a load id (the next free one, or the given one) before any
        data is written; returns it with the lander's token.  A given id that
        is audited raises ValueError, one that another lander holds raises
        FileExistsError, unless ``take_over`` declares that lander dead."""
        token = uuid.uuid4().hex
        doc = json.dumps({"token": token, "at": self.clock().isoformat()})
        if load_id is not None:
            if self.audit().where(F.col("load_id") == load_id).limit(1).count():
                raise ValueError(f"load {load_id} is already committed; loads are never rewritten")
            if take_over:
                delete_path(self.spark, self.reservation_path(load_id))
            write_text_atomic(self.spark, self.reservation_path(load_id), doc)
            return load_id, token
        load_id = self.next_load_id()
        while True:
            try:
                write_text_atomic(self.spark, self.reservation_path(load_id), doc)
                return load_id, token
            except FileExistsError:   # another lander was first
                load_id += 1

    def holds(self, load_id: int, token: str) -> bool:
        """Whether the reservation is still the given lander's."""
        text = read_text(self.spark, self.reservation_path(load_id))
        return text is not None and json.loads(text)["token"] == token

    def footer_rows(self, path: str) -> int:
        """Rows of the Parquet files under ``path`` by their footers alone (an
        aggregate pushed into the scan; no column is read)."""
        if self._footers is None:   # settings of its own, the lake's session keeps its
            own = self.spark.newSession()
            own.conf.set("spark.sql.sources.useV1SourceList", "")
            own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
            self._footers = own
        # the schema is beside the point of a count and saves its inference
        return self._footers.read.schema("x int").parquet(path).agg(F.count(F.lit(1))).first()[0] or 0

    def known_schemas(self) -> dict[str, Callable[[], StructType]]:
        """Per landed table, a call that gives its newest load's schema as it was
        landed (from a control file; the audit is read once for all)."""
        def schema(name: str, load_id: int) -> StructType:
            text = read_text(self.spark, f"{self.raw_path(name, load_id)}/_schema.json")
            return StructType.fromJson(json.loads(text)) if text else self.read_raw(name, load_id).schema

        return {name: partial(schema, name, load[0]) for name, load in self.current_loads().items()}

    def current_loads(self) -> dict[str, tuple[int, dt.datetime, int]]:
        """raw table name -> (newest audited load id, landed_at, rows)."""
        a = self.audit().where(F.col("status") == "loaded")
        latest = a.groupBy("raw_table").agg(
            F.max_by(F.struct("load_id", "landed_at", "row_count"), "load_id").alias("l"))
        # collected timestamps are local and naive; everything else here is aware
        return {r["raw_table"].split(".", 1)[1]: (int(r["l"]["load_id"]),
                                                    r["l"]["landed_at"].astimezone(dt.timezone.utc),
                                                    int(r["l"]["row_count"] or 0))
                for r in latest.collect()}

    def compact_audit(self) -> int:
        """Merge the audit's small files (one per load) into one.

        The merged file is written first and only the files listed before
        are deleted afterwards, so a reader never misses a row (it may see a
        row twice for a moment, which the newest-load logic ignores) and a
        load committing meanwhile is untouched.  A refresh stream replays the
        merged rows as a new file; publishing is idempotent, so that is a
        no-op.  Returns the number of files merged.
        """
        files = [n for n, is_dir in list_dir(self.spark, self.audit_path)
                 if not is_dir and n.startswith("part-") and n.endswith(".parquet")]
        if len(files) <= 1:
            return 0
        paths = [f"{self.audit_path}/{n}" for n in files]
        (self.spark.read.schema(AUDIT_SCHEMA).parquet(*paths).coalesce(1)
         .write.mode("append").parquet(self.audit_path))
        for p in paths:
            delete_path(self.spark, p)
        return len(files)

    def vacuum_raw(self, keep_loads: int = 2, grace_seconds: float = 86400.0) -> list[str]:
        """Delete raw load folders a reader can no longer need: per table,
        every audited load older than the newest ``keep_loads``, and any
        unaudited leftover older than the newest audited load.  A load that a
        lander has reserved and not given back is being written and is kept,
        until the reservation is older than ``grace_seconds``: then the lander
        counts as dead, and its commit is refused should it come back.
        Returns the deleted paths."""
        now = self.clock()
        writing = set()
        done = {r["load_id"] for r in self.audit().select("load_id").distinct().collect()}
        for lid in self.reserved_ids():
            text = read_text(self.spark, self.reservation_path(lid))
            age = (now - dt.datetime.fromisoformat(json.loads(text)["at"])).total_seconds() if text else 0
            if lid not in done and age <= grace_seconds:
                writing.add(lid)
            elif lid < max(done, default=0):   # the newest id stays taken
                delete_path(self.spark, self.reservation_path(lid))
        audited: dict[str, list[int]] = {}
        for r in self.audit().where(F.col("status") == "loaded") \
                .select("raw_table", "load_id").distinct().collect():
            audited.setdefault(r["raw_table"].split(".", 1)[1], []).append(int(r["load_id"]))
        deleted = []
        for name, ids in audited.items():
            ids.sort()
            keep = set(ids[-max(1, keep_loads):])
            newest = ids[-1]
            for entry, is_dir in list_dir(self.spark, self.raw_path(name)):
                if not (is_dir and entry.startswith("load_id=")):
                    continue
                lid = int(entry.split("=", 1)[1])
                if lid in keep or lid in writing or lid > newest:
                    continue
                path = self.raw_path(name, lid)
                delete_path(self.spark, path)
                deleted.append(path)
        return deleted

    def read_raw(self, raw_name: str, load_id: int | None = None) -> DataFrame:
        """A raw table: the newest audited load, or a given one."""
        if load_id is None:
            cur = self.current_loads().get(raw_name)
            if cur is None:
                raise FileNotFoundError(f"no audited load of {raw_name}")
            load_id = cur[0]
        return self.spark.read.parquet(self.raw_path(raw_name, load_id))

    # --- landing -------------------------------------------------------------
    def land(self, source: str, tables: Mapping[str, DataFrame] | str, load_id: int | None = None,
             ignore: str = DEFAULT_IGNORE, **options) -> dict[str, int]:
        """Land every table of one source as a new load; returns {key: rows}.

        ``tables`` is name -> DataFrame, the root folder of the source (each
        child dataset is a table) or ``'catalog:<database>'`` (each table of
        that database).  A missing source is logged and recorded
        (``status='missing'``); nothing is raised.  ``options``: see
        :meth:`land_many`.
        """
        return self.land_many({source: tables}, load_id=load_id, ignore=ignore, **options)

    def _opened(self, sources, ignore: str) -> tuple[list[tuple[str, str, DataFrame]], list[tuple[str, str]]]:
        """(source, table, frame) of every table, and the sources that are missing."""
        writes, missing = [], []
        for source, tables in sources.items():
            if isinstance(tables, str) and tables.startswith(CATALOG_PREFIX):
                db = tables[len(CATALOG_PREFIX):]
                if not self.spark.catalog.databaseExists(db):
                    log.error("source %s: database %s not found; skipped", source, db)
                    missing.append((source, tables))
                    continue
                tables = read_catalog_source(self.spark, db, ignore)
            elif isinstance(tables, str):
                if not path_exists(self.spark, tables):
                    log.error("source %s not found at %s; skipped", source, tables)
                    missing.append((source, tables))
                    continue
                tables = read_source(self.spark, tables, ignore)
            writes += [(source, table, df) for table, df in tables.items()]
        names = [raw_table_name(source, table) for source, table, _ in writes]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:   # before anything is written
            raise ValueError(f"several tables would land as {', '.join(twice)}")
        return writes, missing

    def _write(self, name: str, df: DataFrame, load_id: int) -> int:
        """Write one table of a load; its rows, counted on the write and again
        from the footers."""
        path = self.raw_path(name, load_id)
        obs = Observation(f"land_{name}_{load_id}_{uuid.uuid4().hex[:8]}")
        # the load id is not audited, so whatever sits at this path is the
        # invisible leftover of an interrupted load: replace it
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
        (df.observe(obs, F.count(F.lit(1)).alias("rows"), *nulls)
           .write.mode("overwrite").parquet(path))
        write_text_atomic(self.spark, f"{path}/_nulls.json", json.dumps(
            {c: int(obs.get[f"n{i}"]) for i, c in enumerate(df.columns)}))
        write_text_atomic(self.spark, f"{path}/_schema.json", df.schema.json())
        return int(obs.get["rows"])

    def _commit(self, load_id: int, token: str, rows: list[tuple]) -> None:
        """Make a load visible: its audit rows, moved in as one finished file.
        (Appends side by side into one folder would delete each other's
        temporary files.)"""
        part = fresh_dir(self.spark, "audit")
        self.spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.parquet(part)
        file = next(n for n, _ in list_dir(self.spark, part) if n.endswith(".parquet"))
        if not self.holds(load_id, token):
            raise FileExistsError(f"load {load_id} was given to another lander")
        move_into(self.spark, f"{part}/{file}", f"{self.audit_path}/part-{load_id:09d}-{token}.parquet")
        delete_path(self.spark, part)

    def land_many(self, sources: Mapping[str, Mapping[str, DataFrame] | str],
                  load_id: int | None = None, ignore: str = DEFAULT_IGNORE,
                  drift: DriftPolicy = AS_LANDED, expected: Mapping[str, StructType] | None = None,
                  take_over: bool = False) -> dict[str, int]:
        """Land several sources as ONE load id, with one audit commit at the end.

        ``drift`` says what happens to columns unlike the table's ``expected``
        schema (by raw table name) or, without one, that of its newest load.
        Other landers may run at the same time.  ``take_over``: a given
        ``load_id`` that a dead lander has reserved is taken from it.
        """
        self.ensure_namespace(RAW_LAYER)
        load_id, token = self.reserve(load_id, take_over)
        try:
            return self._land(load_id, token, *self._opened(sources, ignore), drift, expected or {})
        except BaseException:   # nothing was audited: the id is free again
            if self.holds(load_id, token):
                delete_path(self.spark, self.reservation_path(load_id))
            raise

    def _land(self, load_id: int, token: str, writes, missing, policy: DriftPolicy,
              expected: Mapping[str, StructType]) -> dict[str, int]:
        landed_at, landed = self.clock(), self.known_schemas()
        rows = [(f"{RAW_LAYER}.{raw_table_name(source, '*')}", source, "*", load_id, None, "missing", landed_at,
                 where, None) for source, where in missing]

        def write(item: tuple[str, str, DataFrame]) -> tuple[int | None, Drift]:
            source, table, df = item
            name = raw_table_name(source, table)
            known = expected.get(name) or (landed[name]() if name in landed else None)
            found = compare(known, df.schema, policy)
            if found.rejected:
                log.error("%s load %d rejected: %s", name, load_id, found.text)
                return None, found
            return self._write(name, reconciled(df, found), load_id), found

        # tables are independent jobs: submit a few at once (any failure raises
        # here, before the audit commit, so a partial load never becomes visible)
        with ThreadPoolExecutor(max_workers=max(1, min(self.parallelism, len(writes)))) as pool:
            done = list(pool.map(write, writes))
            results: dict[str, int] = {}
            checked: list[tuple[str, int]] = []
            for (source, table, _df), (count, found) in zip(writes, done):
                name, key = raw_table_name(source, table), result_key(source, table)
                path = self.raw_path(name, load_id) if count is not None else None
                rows.append((key, source, table, load_id, count, "loaded" if count is not None else "rejected",
                             landed_at, path, found.text))
                if count is not None:
                    results[key] = count
                    checked.append((path, count))
            for (path, count), stored in zip(checked, pool.map(self.footer_rows, [p for p, _ in checked])):
                if stored != count:
                    raise LoadCountError(f"{path}: {count} rows were written, the files hold {stored}")
        if rows:
            self._commit(load_id, token, rows)
            self.register_raw_views()   # readers of the views see the load at once
            for after in self.after_commit:
                after(self)
        log.info("raw load %d complete: %d tables", load_id, len(results))
        return results
