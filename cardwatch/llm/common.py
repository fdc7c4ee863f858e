"""Helpers shared by the corpus operators: table reads, scratch files, Arrow row loops."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.config import materialize, scratch_path, shared_root

#: Separators of the contracts' words: space and the control characters tab to CR.
SPACE = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="cardwatch-py-"), "cardwatch_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "cardwatch")):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash over every column of a row; equal rows have equal hashes."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def batches_of(spark: SparkSession, rows: int = 512) -> None:
    """Get ready for Python tasks: modules, and rows and bytes of one Arrow batch; long texts make the default of 10,000 rows too
    large for a Python worker's share of an executor."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def given_back() -> None:
    """Return what a finished task's arrays have left with this worker's allocators, so that
    idle workers stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """A task's function on batches that gives memory back when it ends: a worker that waits
    for a later stage counts in its executor's memory."""
    def task(batches):
        yield from run(batches)
        given_back()
    return task


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def open_fs(uri: str):
    """(filesystem, path) of a URI in the shared folder: file, hdfs, s3, gs as pyarrow
    supports them, so that tasks can write and read single files there. Hadoop's names of the
    S3 scheme are pyarrow's ``s3``."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A name no other attempt of the task uses. Only the manifest, which Spark commits
    once per task, says which files count; those of lost attempts are never read."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


__all__ = ["ship", "SPACE", "table", "text_or_empty", "row_hash", "batches_of", "record_batch", "trimmed",
           "open_fs", "new_file", "materialize", "scratch_path", "shared_root"]
