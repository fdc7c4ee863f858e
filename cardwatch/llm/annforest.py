"""Nearest neighbours by cosine with a hash-prefix forest.

The rows are dealt to shards of about ``shard_rows``. A shard hashes its different vectors
to one long bit string a tree (signs of random projections) and keeps each tree as a sorted
array. A query descends in every tree to the entries with the longest common prefix, which
are one range of the array, and then ascends in all trees together, one bit at a time,
until the ranges hold ``share`` of the shard (with repeats) and at least ``LEAST`` different
entries that are not the query's own; only these candidates are scored. A shard with fewer
entries is scored whole. The best of each shard are merged. Every row is indexed, in its shard; queries visit all shards in
blocks of an Arrow batch.

The share, with its number of trees, is set for vectors without any structure, whose nearest
neighbours are hardly nearer than others; recall is measured in the tests.

Defined cases: a null vector, a zero one, or one with null or non-finite components takes no
part, as query or candidate; nor does a row with a null id. Vectors are compared with those
of equal length. Equal vectors are one entry of a tree, with all their ids. A query's own
row is told by its id. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of

TREES, BITS = 64, 32
#: Entries of all trees' ranges together, as a share of a shard's vectors.
SHARE = 0.9
#: Different entries, beside the query's own, that a search scores at least, or the whole shard.
LEAST = 500
SHARD_ROWS = 20_000
SEED = 11
#: Candidates scored again in double precision, beyond the k best in single precision.
SPARE = 16


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest entry, which is exact and changes no
    cosine; squares of very large or small entries then neither over- nor underflow. (Entries
    2^-1000 times the largest may become zero; they are nothing to the cosine.)"""
    _, e = np.frexp(np.abs(v).max(axis=1, keepdims=True))
    return np.ldexp(v, -e)


class Forest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES,
                 bits: int = BITS, share: float = SHARE):
        """``vectors``: float64 rows, finite and not zero."""
        whole = vectors.view(f"V{vectors.shape[1] * 8}").ravel()
        _, first, entry = np.unique(whole, return_index=True, return_inverse=True)
        self.vectors = scaled(vectors[first])
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.unit = (self.vectors / self.norms[:, None]).astype(np.float32)
        order = np.lexsort((ids, entry))  # each entry's ids, ascending
        self.ids = ids[order]
        self.ends = np.cumsum(np.bincount(entry, minlength=len(first)))
        self.low_id = self.ids[np.concatenate([[0], self.ends[:-1]])]
        self.high_id = self.ids[self.ends - 1]
        self.bits, self.trees = bits, trees
        self.wanted = max(1, int(np.ceil(share * len(first))))
        self.planes = np.random.default_rng(SEED).normal(
            size=(vectors.shape[1], trees * bits)).astype(np.float32)
        keys = self.keys(self.unit)
        self.order = np.argsort(keys, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(keys.T, self.order, axis=1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The bit string of each vector (row) in each tree (column)."""
        out = np.empty((len(unit), self.trees), np.uint64)
        weight = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        for at in range(0, len(unit), 2048):
            s = (unit[at:at + 2048] @ self.planes > 0).reshape(-1, self.trees, self.bits)
            out[at:at + 2048] = (s * weight).sum(axis=2, dtype=np.uint64)
        return out

    def candidates(self, keys: np.ndarray, query_id: int, k: int) -> np.ndarray:
        """Entries for one query: ranges of the longest prefixes at which all trees together
        hold enough, with repeats, and enough different entries with another id."""
        n = self.sorted.shape[1]
        for level in range(self.bits, -1, -1):
            drop = np.uint64(self.bits - level)
            low = (keys >> drop) << drop
            high = low + (np.uint64(1) << drop)
            a = [int(t.searchsorted(x)) for t, x in zip(self.sorted, low)]
            b = [int(t.searchsorted(x)) for t, x in zip(self.sorted, high)]
            if level == 0 or sum(b) - sum(a) >= self.wanted:
                mark = np.zeros(n, bool)
                for t in range(self.trees):
                    mark[self.order[t, a[t]:b[t]]] = True
                cand = np.flatnonzero(mark)
                others = np.count_nonzero((self.low_id[cand] != query_id)
                                          | (self.high_id[cand] != query_id))
                if level == 0 or others >= max(LEAST, k):
                    return cand
        return np.arange(n)

    def search(self, query_id: int, q: np.ndarray, key: np.ndarray, k: int):
        """(id, score) of the k nearest found, nearest first, ties to smaller ids."""
        q = scaled(q[None])[0]
        unit = (q / np.sqrt((q * q).sum())).astype(np.float32)
        cand = self.candidates(key, query_id, k)
        near = self.unit[cand] @ unit
        take = min(len(cand), k + 1 + SPARE)
        top = np.partition(near, len(near) - take)[len(near) - take]
        pick = cand[near >= top - 1e-5]
        score = (self.vectors[pick] * q).sum(axis=1) / (
            self.norms[pick] * np.sqrt((q * q).sum()))
        score = np.clip(score, -1.0, 1.0)
        rows = []
        for e, s in zip(pick, score):
            a, b = self.ends[e - 1] if e else 0, self.ends[e]
            own = self.ids[a:b]
            lo, hi = np.searchsorted(own, query_id), np.searchsorted(own, query_id, "right")
            rows += [(float(s), int(v)) for v in (*own[:min(lo, k)], *own[hi:hi + k])]
        rows.sort(key=lambda x: (-x[0], x[1]))
        return [(v, s) for s, v in rows[:k]]


OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k, trees, bits, share):
    def run(batches):
        shard, forest, ids, vecs = None, None, [], []
        for batch in batches:
            sh = batch.column("shard").to_pylist()
            is_q = batch.column("is_query").to_numpy(zero_copy_only=False)
            vid = batch.column("vec_id").to_numpy()
            col = batch.column("v")
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            off = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
            out = []
            cut = [0, *[j for j in range(1, len(sh)) if sh[j] != sh[j - 1]
                        or is_q[j] != is_q[j - 1]], len(sh)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if sh[a] != shard:
                    shard, forest, ids, vecs = sh[a], None, [], []
                part = np.ascontiguousarray(flat[off[a]:off[b]].reshape(b - a, -1))
                if not is_q[a]:
                    ids.append(vid[a:b])
                    vecs.append(part)
                    continue
                if not ids:
                    continue
                if forest is None:
                    forest = Forest(np.concatenate(ids), np.concatenate(vecs), trees, bits, share)
                part = scaled(part)
                unit = (part / np.sqrt((part * part).sum(axis=1, keepdims=True)))
                keys = forest.keys(unit.astype(np.float32))
                for j in range(b - a):
                    q = int(vid[a + j])
                    out += [(q, v, s) for v, s in forest.search(q, part[j], keys[j], k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, OUT)],
                schema=OUT)
    return run


def search(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 5, trees: int = TREES, bits: int = BITS, share: float = SHARE,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of ``df`` to each row of
    ``queries`` (rows of the same columns)."""
    spark = df.sparkSession
    batches_of(spark, 2048)

    def usable(d):
        v = F.col(vec_col)
        return d.filter(F.col(id_col).isNotNull() & F.forall(
            v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0)).select(
            F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))

    rows, asked = usable(df), usable(queries)
    shards = max(1, -(-rows.count() // shard_rows))
    part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards))
    indexed = rows.select(F.struct(F.size("v").alias("d"), part.alias("s")).alias("k"),
                          F.lit(False).alias("is_query"), "vec_id", "v")
    probes = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast(
        "long"))).alias("s"), "vec_id", "v").select(
        F.struct(F.size("v").alias("d"), F.col("s")).alias("k"), F.lit(True).alias("is_query"),
        "vec_id", "v")
    dealt = (indexed.unionByName(probes)
             .select(F.concat_ws(":", "k.d", "k.s").alias("shard"), "is_query", "vec_id", "v")
             .repartition("shard").sortWithinPartitions("shard", "is_query"))
    found = dealt.mapInArrow(_search(k, trees, bits, share),
                             "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
