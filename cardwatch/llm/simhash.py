"""SimHash near-duplicates with vantage-point shards.

Texts become 64-bit fingerprints of their word shingles; fingerprints that differ in at
most ``max_bits`` bits are linked, and linked ones form components.

Finding all links exactly: the 64 bits are cut into ``max_bits // (margin + 1) + 1`` blocks,
so that two linked fingerprints differ in at most ``margin`` bits of some block. For each
block (a view), a vantage-point tree over the Hamming distance of that block deals the
different fingerprints to shards: a node sends a value inside or outside its vantage
point's ball, and, by the triangle inequality, also to the other side where the ball's
boundary is within ``margin`` (none with the default margin of 0). A shard orders its
fingerprints by their full distance to a vantage point and compares only within
``max_bits`` of it, walking each component once. The trees come from a bounded sample and
only steer the balance: every fingerprint is dealt, every overlapping shard is searched.
A shard above ``shard_rows`` is split into tiles, each pair of which is one shard.

Shards send a star for each component (not all pairs), and alternating large-star and
small-star steps join the stars; equal fingerprints are one node throughout.

Defined cases: a null text, or one without words, has fingerprint 0 and links like any
other; fewer words than a shingle form one shingle. Rows with null ids take part; a
component of only null ids has a null id. Repeated rows are equal fingerprints. Empty
tables give empty results. Other columns pass through :func:`keep_first_of_group`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, materialize, row_hash, trimmed

WORDS = 4
MAX_BITS = 4
SEED = 42
#: Different fingerprints a shard should hold, and from which it is split into tiles.
LEAF_ROWS, SHARD_ROWS = 2000, 8192
#: Bound of the sample that places vantage points.
SAMPLE = 8192
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, repeats included."""
    w = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    k = min(words, len(w))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(w) - k + 1].tolist()
    stops = ends[k - 1:].tolist()
    h64, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        h = np.fromiter((h64(joined[a:b], SEED) for a, b in zip(
            starts[at:at + HASHES_AT_ONCE], stops[at:at + HASHES_AT_ONCE])), np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(words):
    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column("t").to_pylist()],
                          np.uint64)
            keep = [n for n in batch.schema.names if n != "t"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array(fp.view(np.int64))],
                names=[*keep, "fp"])
    return run


def with_fingerprints(df: DataFrame, keys: DataFrame, words: int = WORDS) -> DataFrame:
    """``keys``: the key columns to keep and the text as ``t``."""
    batches_of(df.sparkSession)
    schema = keys.drop("t").schema.add("fp", "long")
    return keys.mapInArrow(trimmed(_fingerprints(words)), schema)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


# --- vantage-point trees over a block of bits ----------------------------------------
def build_tree(values: np.ndarray, leaf: int, seed: int, depth: int = 0):
    """(vantage point, radius, inside, outside), or None for a leaf."""
    if len(values) <= leaf or depth >= 24:
        return None
    rng = np.random.default_rng(seed)
    best = None
    for v in rng.choice(values, min(8, len(values)), replace=False):
        d = _bits(values ^ v)
        for r in {int(np.median(d)), int(np.median(d)) - 1}:
            inside = int((d <= r).sum())
            if 0 < inside < len(values) and (best is None or abs(2 * inside - len(values))
                                             < best[0]):
                best = (abs(2 * inside - len(values)), v, r)
    if best is None:
        return None
    _, v, r = best
    near = _bits(values ^ v) <= r
    return (v, r, build_tree(values[near], leaf, 2 * seed + 1, depth + 1),
            build_tree(values[~near], leaf, 2 * seed + 2, depth + 1))


def leaves_of(tree, values: np.ndarray, margin: int):
    """(row, leaf) pairs: the shard of each value, and those whose region is within
    ``margin`` of it."""
    out = []

    def walk(node, rows, path):
        if not len(rows):
            return
        if node is None:
            out.append((rows, np.full(len(rows), path)))
            return
        v, r, inside, outside = node
        d = _bits(values[rows] ^ v)
        walk(inside, rows[d - margin <= r], 2 * path)
        walk(outside, rows[d + margin > r], 2 * path + 1)

    walk(tree, np.arange(len(values)), 1)
    return (np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out]))


def views_of(max_bits: int, margin: int) -> list[tuple[int, np.uint64]]:
    """(shift, mask) of blocks; two values within max_bits are within margin in one."""
    m = max_bits // (margin + 1) + 1
    edges = [64 * k // m for k in range(m + 1)]
    return [(a, np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]


def _deal(forest_bc, views, margin):
    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            rows, leaf, view = [], [], []
            for k, ((shift, mask), tree) in enumerate(zip(views, forest_bc.value)):
                r, p = leaves_of(tree, (fp >> np.uint64(shift)) & mask, margin)
                rows.append(r)
                leaf.append(p)
                view.append(np.full(len(r), k))
            r = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(view).astype(np.int32)),
                 pa.array(np.concatenate(leaf).astype(np.int64)),
                 pa.array(fp[r].view(np.int64))], names=["view", "leaf", "fp"])
    return run


def components_in(x: np.ndarray, max_bits: int) -> np.ndarray:
    """For different values: index of a representative of each value's component.

    Sorted by distance to a vantage point; by the triangle inequality, only values whose
    distances to it differ by at most max_bits can be linked.
    """
    n = len(x)
    d = _bits(x ^ x[0])
    order = np.argsort(d, kind="stable")
    xs, ds = x[order], d[order]
    lo = np.searchsorted(ds, ds - max_bits, "left")
    hi = np.searchsorted(ds, ds + max_bits, "right")
    root = np.full(n, -1)
    for s in range(n):
        if root[s] >= 0:
            continue
        root[s] = s
        todo = [s]
        while todo:
            i = todo.pop()
            a, b = lo[i], hi[i]
            new = a + np.flatnonzero((np.bitwise_count(xs[a:b] ^ xs[i]) <= max_bits)
                                     & (root[a:b] < 0))
            root[new] = s
            todo.extend(new.tolist())
    out = np.empty(n, np.int64)
    out[order] = order[root]
    return out


def _stars(max_bits):
    def run(batches):
        held: list[np.ndarray] = []
        last = None

        def flush():
            x = np.unique(np.concatenate(held))
            root = x[components_in(x, max_bits)]
            k = np.flatnonzero(root != x)
            return pa.RecordBatch.from_arrays(
                [pa.array(x[k].view(np.int64)), pa.array(root[k].view(np.int64))],
                names=["u", "v"])

        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64)
                             for n in ("view", "leaf", "tile_a", "tile_b")], axis=1)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(fp):
                continue
            cut = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1,
                                  [len(fp)]])
            for a, b in zip(cut, cut[1:]):
                key = tuple(keys[a])
                if key != last and held:
                    yield flush()
                    held = []
                last = key
                held.append(fp[a:b].copy())
        if held:
            yield flush()
    return run


def star_edges(fps: DataFrame, max_bits: int = MAX_BITS, margin: int = 0,
               leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stars (u, v) over different fingerprints (column ``fp``) that connect exactly those
    which links of at most ``max_bits`` bits connect."""
    spark = fps.sparkSession
    views = views_of(max_bits, margin)
    total = fps.count()
    # A share of the fingerprints by hash, so that tasks send about the sample in all.
    share = min(1.0, 2 * SAMPLE / max(1, total))
    some = fps.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array([r[0] for r in some.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
                      np.int64).view(np.uint64)
    leaf = max(1, int(len(sample) * min(1.0, leaf_rows / max(1, total))))
    forest = [build_tree((sample >> np.uint64(s)) & m, leaf, 17 + k)
              for k, (s, m) in enumerate(views)]
    dealt = materialize(fps.select("fp").mapInArrow(
        trimmed(_deal(spark.sparkContext.broadcast(forest), views, margin)),
        "view int, leaf long, fp long"), "simhash_dealt")
    # Large shards only: their number is below views * rows / shard_rows.
    large = materialize(dealt.groupBy("view", "leaf").count().filter(F.col("count") > shard_rows)
                        .select("view", "leaf", F.ceil(F.col("count") / (shard_rows // 2))
                                .cast("int").alias("tiles")), "simhash_large")
    j = dealt.join(large, ["view", "leaf"], "left").withColumn(
        "tile", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int"))
    plain = j.filter("tiles IS NULL").select("view", "leaf", F.lit(0).alias("tile_a"),
                                             F.lit(0).alias("tile_b"), "fp")
    tiles = j.filter("tiles IS NOT NULL").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "view", "leaf", F.least("tile", "other").alias("tile_a"),
        F.greatest("tile", "other").alias("tile_b"), "fp")
    key = ["view", "leaf", "tile_a", "tile_b"]
    return (plain.unionByName(tiles).repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(trimmed(_stars(max_bits)), "u long, v long"))


def connect(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of an edge; root is the smallest node of its component.

    Large-star: each node links its larger neighbours to its smallest. Small-star: each
    node links its smaller neighbours and itself to its smallest. Repeated, however long it
    takes, until nothing changes; each round is written, which cuts the lineage.
    """
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .filter("u != v").distinct(), "star_edges")
    seen = None
    while True:
        both = e.union(e.select("v", "u"))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn(
            "m", F.least("m", "u")), "star_low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v"))
        large = materialize(large.filter("u != v").distinct(), "star_large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "star_low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u != v").union(low.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(small, "star_edges")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                      .first())
        if state == seen:
            break
        seen = state
    return e.groupBy("u").agg(F.min("v").alias("root"))


def labels(fps: DataFrame, **kw) -> DataFrame:
    """(fp, root) of every different fingerprint in the column ``fp``."""
    nodes = materialize(fps.select("fp").distinct(), "simhash_nodes")
    roots = materialize(connect(star_edges(nodes, **kw)), "simhash_roots")
    return nodes.join(roots, nodes["fp"] == roots["u"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               words: int = WORDS, **kw) -> DataFrame:
    """Per row: id, fingerprint in hex, smallest id of its component."""
    fps = materialize(with_fingerprints(df, df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")), words), "simhash_fps")
    roots = materialize(labels(fps, **kw), "simhash_labels")
    by_fp = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    by_root = by_fp.join(roots, "fp")
    ids = materialize(by_root.groupBy("root").agg(F.min("least").alias("component_id")),
                      "simhash_ids")
    named = materialize(roots.join(ids, "root").select("fp", "component_id"), "simhash_named")
    return fps.join(named, "fp").select(
        F.col("doc_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def keep_first_of_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        words: int = WORDS, **kw) -> DataFrame:
    """One row of each component: that of the smallest id (null ids last), of equal ids
    that with the smallest row hash; of rows equal in every column, one."""
    key = df.select(F.col(id_col).alias("i"), row_hash(df).alias("rh"),
                    F.col(text_col).alias("t"))
    fps = materialize(with_fingerprints(df, key, words), "simhash_fps")
    roots = materialize(labels(fps, **kw), "simhash_labels")
    first = F.min(F.struct(F.col("i").isNull().alias("z"), "i", "rh")).alias("f")
    by_fp = materialize(fps.groupBy("fp").agg(first), "simhash_firsts")
    winners = by_fp.join(roots, "fp").groupBy("root").agg(F.min("f").alias("f")).select(
        F.col("f.i").alias("i"), F.col("f.rh").alias("rh"))
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("ri"),
                     row_hash(df).alias("rrh"))
    kept = rows.join(winners, F.col("ri").eqNullSafe(F.col("i")) & (F.col("rrh") == F.col("rh")))
    one = Window.partitionBy("ri", "rrh").orderBy("rrh")
    return kept.withColumn("nth", F.row_number().over(one)).filter("nth = 1").select("row.*")
