"""Session settings and the shared work folder.

Everything the library writes (landed snapshots, published versions,
streaming checkpoints) goes under one shared root.  On a cluster that root is
the folder named by ``spark.checkpoint.dir``; we only pick a local folder when
the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  ANSI mode makes malformed casts fail the
# job (as the warehouse does); UTC keeps date casts engine-independent.
SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 captures the Python call site on every Column call for error
    # context; that costs milliseconds per expression when building plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "unilake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.2,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a given input volume and cluster.

    The library's shuffles carry narrow rows (unique check: 8-byte hash +
    count; change set: key + hash), a fraction of the input bytes
    (``shuffle_fraction``).  Shuffle partitions are sized to hold about
    ``target_partition_bytes`` of that each -- never fewer than two waves of
    the cluster's cores, and not so many that map x reduce shuffle blocks
    explode.  AQE then coalesces small partitions and splits skewed ones.
    Example: 100 TB on 1000 executors x 8 cores -> 81,920 shuffle partitions,
    128 MB input splits.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def size_shuffles(spark: SparkSession, *frames: DataFrame) -> int:
    """Raise the session's shuffle partitions to what the frames' estimated
    bytes ask for (see :func:`scale_conf`); AQE merges partitions that turn
    out small but never adds any.  Frames without an estimate are left out."""
    sizes = [int(str(f._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for f in frames]
    known = sum(n for n in sizes if n < 1 << 60)
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    need = int(scale_conf(known, 0)["spark.sql.shuffle.partitions"])
    if need > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(need))
    return max(need, now)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime settings to an existing session (e.g. the driver's)."""
    for k, v in SESSION_CONF.items():
        # static settings (e.g. the debugging flag) only apply at session start
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def work_root(spark: SparkSession) -> str:
    """The shared folder for everything this library writes.

    Read from ``spark.checkpoint.dir`` (the cluster's shared, fault-tolerant
    folder).  Only when it is unset -- local runs and tests -- a fresh local
    folder is created and registered as the checkpoint dir too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="unilake-"))
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared work root."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_dir) for the direct children of ``path`` via Hadoop FS."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted((st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(p))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file (pointer, reservation, check counts) so that
    readers see all of it or nothing, and only one of several writers succeeds:
    a temporary sibling is written, then takes the name in one step that fails
    where the name exists (a hard link on a local disk, a rename without
    overwriting elsewhere).  Raises FileExistsError."""
    fs, final = _fs_path(spark, path)
    if fs.exists(final):
        raise FileExistsError(path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        _take_name(spark, fs, tmp, final)
    except Py4JJavaError as exc:
        if "AlreadyExists" in exc.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise
    finally:
        fs.delete(tmp, False)


def _take_name(spark: SparkSession, fs, tmp, final) -> None:
    jvm = spark.sparkContext._jvm
    if fs.getUri().getScheme() == "file":
        def local(p):
            return jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
        jvm.java.nio.file.Files.createLink(local(final), local(tmp))
    else:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        kind = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            tmp, final, spark.sparkContext._gateway.new_array(kind, 0))


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished file its final name; the target must be free."""
    fs, src = _fs_path(spark, source)
    _, dst = _fs_path(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise FileExistsError(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small control file's content, or None when it does not exist."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder through the Hadoop file system."""
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
