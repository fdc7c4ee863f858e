"""Whitening of vectors by shifted CholeskyQR.

A finite vector becomes whole numbers ``x = floor(64 * c) + 1000000``; the fit list holds each
different one once, written to the shared folder. With n rows and sums S, the centred row is
``(n * x - S) / n``, its numerator exact. A pass over the fit list adds up the Gram matrix of
the rows as they are so far; its Cholesky factor R makes them more orthogonal through a
triangular solve (the first pass shifts the Gram matrix, so that the factor exists however
badly conditioned it is), until the Gram matrix is the identity. The product of the factors is
the R of the centred rows, and its SVD gives eigenvalues and eigenvectors of the covariance
without ever squaring small singular values away. One more pass measures how far the whitened
rows' covariance is from the identity.

Each task adds up its own matrices, and tasks that add them row by row follow; the driver gets
one matrix of the vectors' length a pass, never a row of data.

Defined cases: a null or empty vector, or one with null or non-finite components, takes no
part. Vectors of another length are fitted on their own, so no row is lost. A number beyond
+-2^62 counts as that bound. Directions without variance are no components, so a row has at
most as many as the fit list's rank: none where all vectors are equal. ``deviation`` is null
where it does not fit 64 bits; ``deviation_text`` holds its digits then. Null ids and repeated
rows stay as they are. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialize, record_batch

SCALE, OFFSET = 64, 1_000_000
BOUND = 1 << 62
#: The Gram matrix has settled when its eigenvalues are this near to 1; those below NULL of
#: it belong to directions without variance once so many passes have been made.
SETTLED, NULL, PASSES, MOST = 1e-10, 1e-3, 4, 10
#: A direction with this share of the largest eigenvalue or less has no variance.
FLAT = 1e-18
EPS = float(np.finfo(np.float64).eps) / 2


def fixed(vec_col: str) -> Column:
    """The vector as whole numbers."""
    def whole(c):
        c = F.floor(c.cast("double") * SCALE)
        return F.least(F.greatest(c, F.lit(-BOUND)), F.lit(BOUND)) + F.lit(OFFSET).cast("long")
    return F.transform(F.col(f"`{vec_col}`"), whole)


def usable(vec_col: str) -> Column:
    v = F.col(f"`{vec_col}`")
    return (v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                       & (F.abs(c.cast("double")) < float("inf"))))


def rows_of(column) -> np.ndarray:
    """The rows of a list column of one length as an array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as 64-bit numbers where they fit, else as Python's."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (numerators(x, n, sums) / n).astype(np.float64)


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q @ r = a, for an upper triangular r: forward through the columns."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _sums(batches):
    """Of each task: count, and sums of the high and low halves of the numbers."""
    n, high, low = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            x = rows_of(batch.column(0))
            n += len(x)
            high = high + (x >> 32).sum(axis=0)
            low = low + (x & 0xFFFFFFFF).sum(axis=0)
    schema = pa.schema([("n", pa.int64()), ("high", pa.list_(pa.int64())),
                        ("low", pa.list_(pa.int64()))])
    yield record_batch(schema, *([[n], [high], [low]] if n else [[], [], []]))


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """(number of rows, exact sum of each dimension) of the column ``x``."""
    parts = fit.select("x").mapInArrow(_sums, "n long, high array<long>, low array<long>")
    whole = F.lit(0).cast("decimal(38,0)")
    got = (parts.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("j", "s"))
           .groupBy("j").agg(F.sum("n").alias("n"), F.sum(whole + F.col("s.high")).alias("high"),
                             F.sum(whole + F.col("s.low")).alias("low")).orderBy("j").collect())
    return (got[0]["n"] if got else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in got]


ROW = pa.schema([("i", pa.int32()), ("g", pa.list_(pa.float64()))])


def _partial(n, sums, onto):
    def run(batches):
        g = 0.0
        for batch in batches:
            if batch.num_rows:
                q = onto(centred(rows_of(batch.column(0)), n, sums))
                g = g + q.T @ q
        rows = list(g) if np.ndim(g) else []
        yield record_batch(ROW, range(len(rows)), rows)
    return run


def _added(batches):
    rows: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, g in zip(batch.column(0).to_pylist(), rows_of(batch.column(1))
                        if batch.num_rows else ()):
            rows[i] = rows[i] + g if i in rows else g.copy()
    yield record_batch(ROW, list(rows), list(rows.values()))


def gram(fit: DataFrame, n: int, sums: list[int], onto) -> np.ndarray:
    """Sum of q q^T over the fit list, q being ``onto`` of the centred rows. The rows of the
    tasks' matrices are added up by tasks; as many come to the driver as the matrix has."""
    rows = (fit.select("x").mapInArrow(_partial(n, sums, onto), "i int, g array<double>")
            .repartition("i").mapInArrow(_added, "i int, g array<double>").collect())
    return np.array([r["g"] for r in sorted(rows, key=lambda r: r["i"])])


def orthogonal(factors: list[np.ndarray]):
    def onto(a):
        for r in factors:
            a = solve_right(a, r)
        return a
    return onto


def r_factor(n: int, d: int, gram_of) -> tuple[np.ndarray, float, list[float]]:
    """(R, trace of the rows' Gram matrix, distance from the identity after each pass) by
    shifted CholeskyQR; ``gram_of(factors)`` makes a pass over the rows."""
    factors, trace, far = [], 0.0, []
    for k in range(MOST):
        g = gram_of(factors)
        g = (g + g.T) / 2
        if k == 0:
            trace = float(np.trace(g))
            if trace == 0.0:
                return np.zeros((d, d)), 0.0, far
        else:
            e = np.linalg.eigvalsh(g)
            off = np.abs(e - 1)
            far.append(float(off.max()))
            if off.max() <= SETTLED or k >= PASSES and off[e > NULL].max(initial=0) <= SETTLED:
                break
        shift = 0.0
        if k == 0 or e[0] < NULL:
            shift = 11 * (n * d + d * (d + 1)) * EPS * float(np.trace(g))
        factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    return r, trace, far


class Whitening:
    """Fitted on a column ``x`` of equally long, different vectors of whole numbers."""

    def __init__(self, fit: DataFrame, components: int):
        self.n, self.sums = moments(fit)
        d, n, sums = len(self.sums), self.n, self.sums
        r, trace, self.far = r_factor(n, d, lambda factors: gram(fit, n, sums,
                                                                 orthogonal(factors)))
        _, s, vt = np.linalg.svd(r)
        keep = min(components, int(np.sum(s * s > FLAT * max(s[0] ** 2, 1e-300))))
        w = vt[:keep].T
        lead = np.abs(w).argmax(axis=0) if keep else []
        self.vectors = w * np.sign(w[lead, range(keep)])
        self.eigenvalues = s[:keep] ** 2 / n
        self.explained = s[:keep] ** 2 / trace if keep else s[:0]
        self.whiten = self.vectors / np.sqrt(self.eigenvalues)
        self.identity_error = 0.0
        if keep:
            m = self.whiten
            cov = gram(fit, n, sums, lambda a: a @ m) / n
            self.identity_error = float(np.abs(cov - np.eye(keep)).max())


OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
                 ("deviation", pa.int64()), ("whitened", pa.float64()),
                 ("explained", pa.float64()), ("identity_error", pa.float64()),
                 ("deviation_text", pa.string())])
OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double, deviation_text string")


def _squares(num: np.ndarray) -> list[int]:
    if num.dtype != object:
        most = int(np.abs(num).max(initial=0))
        if most * most * num.shape[1] < 1 << 63:
            return (num * num).sum(axis=1).tolist()
        num = num.astype(object)
    return [int(v) for v in (num * num).sum(axis=1)]


def _project(n, sums, whiten, explained, error):
    k = whiten.shape[1]

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            num = numerators(rows_of(batch.column(1)), n, sums)
            z = (num / n).astype(np.float64) @ whiten
            dev = _squares(num)
            fits = [v if v < 1 << 63 else None for v in dev]
            text = [None if f is not None else str(v) for f, v in zip(fits, dev)]
            again = np.repeat(np.arange(m), k)
            ids = batch.column(0).take(pa.array(again))
            yield record_batch(OUT, ids, np.tile(np.arange(1, k + 1), m), np.full(m * k, n),
                               pa.array(fits, pa.int64()).take(pa.array(again)), z.ravel(),
                               np.tile(explained, m), np.full(m * k, error),
                               pa.array(text, pa.string()).take(pa.array(again)))
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = 16) -> DataFrame:
    """A row for each usable row of ``df`` and component, largest variance first."""
    spark = df.sparkSession
    batches_of(spark, 2048)
    rows = df.filter(usable(vec_col)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                                             fixed(vec_col).alias("x"))
    fit = materialize(rows.select("x").distinct(), "whitening_fit")
    parts = []
    for (d,) in fit.groupBy(F.size("x").alias("d")).count().select("d").orderBy("d").collect():
        w = Whitening(fit.filter(F.size("x") == d), components)
        if len(w.eigenvalues):
            parts.append(rows.filter(F.size("x") == d).mapInArrow(
                _project(w.n, w.sums, w.whiten, w.explained, w.identity_error), OUT_SCHEMA))
    return reduce(DataFrame.unionByName, parts) if parts else \
        spark.createDataFrame([], OUT_SCHEMA)
