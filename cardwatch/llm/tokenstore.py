"""Token ids in binary shards, one zstandard frame a document, under a shared dictionary.

A shard file: magic, SHA-256 of the dictionary, bytes of an id (2 or 4); the frames; the
index (ids of the documents, a null flag, frame offsets, token counts); its place and
length. The dictionary is a file of its own beside the shards, named by its hash, trained
on serialized id arrays of a bounded sample. A reader checks the hash, and can fetch one
short document through the index without reading the shard.

Documents are range partitioned and sorted by id, and a task writes one shard under a name
of its own. The manifest, committed by Spark, says which files count: what a lost attempt
wrote is never read.

Defined cases: null and empty texts hold only the end id. Null ids come first. Repeated
ids follow each other, by the hash of their text. An empty table has no shard. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialize, new_file, open_fs, record_batch, scratch_path
from .wordtokens import END_ID, encoder, tokenizer_path

MAGIC = b"CWTOKEN1"
HEAD = struct.Struct("<8s32sB")
TAIL = struct.Struct("<QQ8s")
DICTIONARY_BYTES = 64 << 10
#: Bounds of the dictionary's sample: texts, and characters taken from the middle of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 1500, 2000
LEVEL = 3

MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()),
                      ("n_tokens", pa.int64())])
ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                 ("ids_crc32", pa.int64())])


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; where samples are too few to train one, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) + bytes(64))[:size]


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data)


def sample_ids(df: DataFrame, id_col: str, text_col: str, path: str, width: int) -> list[bytes]:
    t = F.coalesce(F.col(text_col), F.lit(""))
    mid = F.greatest(F.floor((F.length(t) - SAMPLE_CHARS) / 2), F.lit(0)).cast("int") + 1
    # A share of the rows by hash, so that tasks send about the sample and not each one.
    share = min(1.0, 2 * SAMPLE_TEXTS / max(1, df.count()))
    rows = (df.select(F.xxhash64(id_col, text_col).alias("h"),
                      F.substring(t, mid, F.lit(SAMPLE_CHARS)).alias("s"))
            .filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))
            .orderBy("h", "s").limit(SAMPLE_TEXTS).collect())
    enc = encoder(path)
    return [narrowed(enc.id_bytes(r["s"]), width) for r in rows]


def narrowed(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widened(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


class ShardWriter:
    def __init__(self, out, dictionary: bytes, width: int, level: int = LEVEL):
        self.out, self.width, self.at = out, width, HEAD.size
        self.zip = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary))
        self.ids, self.nulls, self.offsets, self.counts = [], [], [HEAD.size], []
        out.write(HEAD.pack(MAGIC, hashlib.sha256(dictionary).digest(), width))

    def add(self, doc_id, ids: bytes) -> None:
        frame = self.zip.compress(narrowed(ids, self.width))
        self.out.write(frame)
        self.at += len(frame)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.offsets.append(self.at)
        self.counts.append(len(ids) // 4)

    def finish(self) -> int:
        index = b"".join([np.array(self.ids, "<i8").tobytes(),
                          np.array(self.nulls, "u1").tobytes(),
                          np.array(self.offsets, "<i8").tobytes(),
                          np.array(self.counts, "<i8").tobytes()])
        self.out.write(index + TAIL.pack(self.at, len(self.ids), MAGIC))
        return sum(self.counts)


class ShardReader:
    """Random access to a shard: ``source`` is a pyarrow input file."""

    def __init__(self, source, dictionary_of):
        self.source = source
        magic, digest, self.width = HEAD.unpack(source.read_at(HEAD.size, 0))
        place, n, tail = TAIL.unpack(source.read_at(TAIL.size, source.size() - TAIL.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("not a token shard")
        data = dictionary_of(digest)
        if hashlib.sha256(data).digest() != digest:
            raise ValueError("the dictionary is not the one that the shard names")
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        index = source.read_at(source.size() - TAIL.size - place, place)
        self.ids = np.frombuffer(index, "<i8", n)
        self.nulls = np.frombuffer(index, "u1", n, 8 * n)
        self.offsets = np.frombuffer(index, "<i8", n + 1, 9 * n)
        self.counts = np.frombuffer(index, "<i8", n, 9 * n + 8 * (n + 1))

    def id_bytes(self, k: int) -> bytes:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        return widened(self.unzip.decompress(self.source.read_at(b - a, a)), self.width)


def _write(folder, path, dictionary, width, end):
    def run(batches):
        enc = writer = None
        shard = TaskContext.get().partitionId()
        name = new_file(folder, f"tokens-{shard:06d}", ".cwt")
        fs, at = open_fs(name)
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if writer is None:
                    enc, out = encoder(path), fs.open_output_stream(at)
                    writer = ShardWriter(out, dictionary.value, width)
                writer.add(i, enc.id_bytes(t, end))
        if writer is not None:
            total = writer.finish()
            out.close()
            yield record_batch(MANIFEST, [shard], [name], [len(writer.ids)], [total])
    return run


def write(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
          tokenizer: str | None = None, end: int = END_ID) -> DataFrame:
    """Write shards in ascending id order; returns the manifest, written as a table."""
    spark = df.sparkSession
    batches_of(spark)
    path = tokenizer or tokenizer_path()
    width = 2 if encoder(path).vocabulary <= 1 << 16 else 4
    data = train_dictionary(sample_ids(df, id_col, text_col, path, width))
    fs, at = open_fs(folder)
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/{hashlib.sha256(data).hexdigest()}.zdict") as out:
        out.write(data)
    rows = df.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"),
                     F.xxhash64(text_col).alias("h"))
    placed = rows.repartitionByRange("i", "h").sortWithinPartitions("i", "h").select("i", "t")
    return materialize(placed.mapInArrow(
        _write(folder, path, spark.sparkContext.broadcast(data), width, end),
        "shard long, path string, n_docs long, n_tokens long"), "token_manifest")


def _read(folder):
    def dictionary_of(digest):
        fs, at = open_fs(folder)
        with fs.open_input_stream(f"{at}/{digest.hex()}.zdict") as f:
            return f.read()

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(),
                                  batch.column("base").to_pylist()):
                fs, at = open_fs(path)
                with fs.open_input_file(at) as source:
                    shard = ShardReader(source, dictionary_of)
                    starts = base + np.cumsum(shard.counts) - shard.counts
                    for k in range(0, len(shard.ids), 4096):
                        s = slice(k, k + 4096)
                        data = [shard.id_bytes(j) for j in range(*s.indices(len(shard.ids)))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(shard.ids[s], mask=shard.nulls[s].astype(bool)),
                             pa.array(starts[s]), pa.array([len(x) // 4 for x in data],
                                                           pa.int64()),
                             pa.array([zlib.crc32(x) for x in data], pa.int64())], schema=ROW)
    return run


def read(spark, manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards. One row a shard comes to the driver, for the numbers
    of ids before each."""
    base, rows = 0, []
    for r in manifest.orderBy("shard").collect():
        rows.append((r["path"], base))
        base += r["n_tokens"]
    batches_of(spark)
    shards = spark.createDataFrame(rows, "path string, base long")
    return shards.repartition(max(1, len(rows))).mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, **kw) -> DataFrame:
    spark = df.sparkSession
    folder = scratch_path(spark, "tokens")
    return read(spark, write(df, folder, **kw), folder)
