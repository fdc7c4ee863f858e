"""Session defaults and the shared scratch location."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job in this package expects. AQE re-plans joins from runtime
# sizes (a broadcast only happens under a measured threshold), coalesces small
# shuffle partitions and splits skewed sort-merge-join partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "cardwatch",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    Read from the session (once per SparkContext); only when it is unset
    (local tests) a folder is created and registered as the checkpoint
    directory.
    """
    sc = spark.sparkContext
    cached = _roots.get(sc.applicationId)
    if cached:
        return cached
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        root = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    _roots[sc.applicationId] = root.rstrip("/")
    return _roots[sc.applicationId]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return "/".join([shared_root(spark), "cardwatch", *parts, uuid.uuid4().hex])


def materialize(df, name: str = "materialized"):
    """Write ``df`` once to a fresh folder under the shared scratch root and
    read it back: lineage is cut (an executor loss re-reads files instead of
    recomputing joins) and every later reader still gets column pruning."""
    path = scratch_path(df.sparkSession, name)
    if scopes := getattr(_scopes, "stack", None):
        scopes[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_scopes = threading.local()  # of each thread: the open scopes' paths


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """What :func:`materialize` writes inside is removed at the end, also after a failure.
    For work whose results are stored before it ends."""
    _scopes.stack = [*getattr(_scopes, "stack", []), []]
    try:
        yield
    finally:
        for path in _scopes.stack.pop():
            remove(spark, path)


# --- folders and single lines by Hadoop's file system, from the driver ------------------
def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, or of the first non-empty data file of a folder."""
    fs, p = _hadoop(spark, path)
    if fs.getFileStatus(p).isDirectory():
        files = sorted((str(f.getPath()), f.getLen()) for f in fs.listStatus(p)
                       if f.isFile() and not f.getPath().getName().startswith(("_", ".")))
        files = [f for f, size in files if size] or [f for f, _ in files]
        if not files:
            return ""
        fs, p = _hadoop(spark, files[0])
    java = spark.sparkContext._jvm.java
    stream = java.io.BufferedReader(java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return (stream.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    fs, p = _hadoop(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that does not exist yet; False where it does. Of several callers
    at once one wins: O_EXCL on local disks, exclusive creation on HDFS, a conditional write
    on S3A."""
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        try:
            f = os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(f, "w", encoding="utf-8") as out:
            out.write(text)
        return True
    try:
        out = (fs.createFile(p).overwrite(False)
               .opt("fs.option.create.conditional.overwrite", "true").build())
        out.write(bytearray(text, "utf-8"))
        out.close()
    except Py4JJavaError as exc:
        if any(k in str(exc.java_exception) for k in
               ("AlreadyExists", "AlreadyBeingCreated", "already exists", "412")):
            return False
        raise
    return True


def append_file(df, path: str) -> None:
    """Append a few rows as one file. Several runs may do so at once: each writes to a folder
    of its own, whose file then moves up (Spark's own append shares one temporary folder)."""
    spark, own = df.sparkSession, f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(own)
    fs, p = _hadoop(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names(spark, own):
        if name.startswith("part-"):
            if not fs.rename(Path(f"{own}/{name}"), Path(p, name)):
                raise OSError(f"{own}/{name} could not be moved to {path}")
    remove(spark, own)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem checks in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "shared_root", "scratch_path", "scratch_scope", "materialize",
           "exists", "remove", "names", "first_line", "age_seconds", "create_new", "append_file",
           "local_path", "SESSION_DEFAULTS"]
