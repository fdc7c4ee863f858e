"""Language identification by a byte-level convolutional network trained in numpy.

The network: byte embeddings, filters of several widths, rectification, max pooling
over a fixed-length window, softmax. A whole text is cut into consecutive windows of that
length, which are scored in batches, and the windows' probabilities, weighted by their
bytes, are averaged.

It learns from every window of every labelled text that is not held out. Tasks train side by
side on rows dealt by the hash of their id, and Spark averages their parameters between
rounds that read growing shares of the rows, each row once. So the network depends on the
rows only, not on how they lie in files. What fills less than two tasks is passed as often
as it takes to train alike.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; an empty
training set labels everything ``und``. Empty tables give empty results. Equal texts
get equal results. Other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, trimmed

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: Windows of a step of the optimiser, and steps of each task in a pass over all rows.
STEP, STEPS = 128, 600
#: Windows that a task mixes before it steps through them.
MIXED = 8192
#: Rows are dealt to 16 slots by the hash of their id; a pass over all rows takes these
#: slots, from and to, between averages.
SLOTS, ROUNDS = 16, ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16))
#: A rare language's windows weigh more, at most so many times.
MOST_WEIGHT = 20.0
#: Parameters are averaged as integers, so that the order of the sum does not matter.
FIXED = 1 << 20
#: Steps of the calibrated score.
SCORE_STEPS = 10_000
#: Windows scored at once (bounds memory for very long texts).
BLOCK = 512


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(df: DataFrame, held: bool, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Text ``t``, label ``y`` and a hash ``h`` of the id of every labelled row, held out or
    not."""
    side = held_out(id_col) if held else ~held_out(id_col)
    return df.filter(side & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()
                     & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(text_col).alias("t"), F.col(lang_col).alias("y"), F.xxhash64(id_col).alias("h"))


def to_windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The whole of ``data`` as rows of WINDOW bytes (zero padded), and bytes of each."""
    n = max(1, -(-len(data) // WINDOW))
    x = np.zeros(n * WINDOW, np.uint8)
    x[:len(data)] = np.frombuffer(data, np.uint8)
    used = np.full(n, WINDOW)
    used[-1] = len(data) - WINDOW * (n - 1)
    return x.reshape(n, WINDOW), used


def started(labels: list, seed: int) -> tuple[dict, np.random.Generator]:
    """Random parameters of a network for so many labels."""
    rng = np.random.default_rng(seed)
    p = {"E": rng.normal(0, 0.5, (256, EMBED)), "b": np.zeros(len(labels)),
         "V": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels)))}
    for w in WIDTHS:
        p[f"W{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
        p[f"c{w}"] = np.zeros(FILTERS)
    return p, rng


def gradients(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """(loss, gradient of each parameter, class probabilities) of windows ``x`` with label
    numbers ``y``: the plain convolution, forward and back."""
    n = len(x)
    emb = p["E"][x]
    pooled, where, cols = [], {}, {}
    for w in WIDTHS:
        c = np.concatenate([emb[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
        a = c @ p[f"W{w}"]
        where[w] = a.argmax(axis=1)
        cols[w] = c
        pooled.append(np.take_along_axis(a, where[w][:, None], 1)[:, 0] + p[f"c{w}"])
    z = np.concatenate(pooled, axis=1)
    act = np.maximum(z, 0)
    logit = act @ p["V"] + p["b"]
    prob = np.exp(logit - logit.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    loss = -(weight * np.log(np.maximum(prob[np.arange(n), y], 1e-30))).sum() / n
    d = prob.copy()
    d[np.arange(n), y] -= 1
    d *= weight[:, None] / n
    g = {"V": act.T @ d, "b": d.sum(axis=0), "E": np.zeros_like(p["E"])}
    dz = (d @ p["V"].T) * (z > 0)
    for k, w in enumerate(WIDTHS):
        dw = dz[:, k * FILTERS:(k + 1) * FILTERS]
        hit = np.take_along_axis(cols[w], where[w][:, :, None], 1)  # n, FILTERS, w*EMBED
        g[f"W{w}"] = np.einsum("nf,nfk->kf", dw, hit)
        g[f"c{w}"] = dw.sum(axis=0)
        de = (dw[:, :, None] * p[f"W{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
        byte = x[np.arange(n)[:, None, None], where[w][:, :, None] + np.arange(w)]
        np.add.at(g["E"], byte, de)
    return loss, g, prob


def flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def shaped(p: dict, values: np.ndarray) -> dict:
    """``values`` as parameters of the shapes of ``p``."""
    out, at = {}, 0
    for k in sorted(p):
        out[k] = values[at:at + p[k].size].reshape(p[k].shape).astype(np.float32)
        at += p[k].size
    return out


class Adam:
    """A network that is fitted step by step."""

    def __init__(self, p: dict):
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.step = 0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, order: np.ndarray) -> None:
        for at in range(0, len(order), STEP):
            pick = order[at:at + STEP]
            _, g, _ = gradients(self.p, x[pick], y[pick], weight[pick])
            self.step += 1
            for k in self.p:
                self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
                self.v[k] = 0.999 * self.v[k] + 0.001 * g[k] ** 2
                self.p[k] = (self.p[k] - 0.004 * (self.m[k] / (1 - 0.9 ** self.step)) / (
                    np.sqrt(self.v[k] / (1 - 0.999 ** self.step)) + 1e-8)).astype(np.float32)


def _trained(p: dict, labels: list, weights: np.ndarray, seed: int, passes: int):
    """One task's part of a round: its parameters (in FIXED, times its windows) and windows.
    With several passes all its windows are held; see `fit` for their bound."""
    number = {y: k for k, y in enumerate(labels)}

    def run(batches):
        net, rng, seen = Adam(p), np.random.default_rng(seed), 0
        held, size = [], 0

        def learn(times):
            x, y, w = map(np.concatenate, zip(*held))
            for _ in range(times):
                net.fit(x, y, w, rng.permutation(len(x)))

        for batch in batches:
            for t, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
                windows, used = to_windows(t.encode("utf-8", "surrogatepass"))
                k, n = number[y], len(windows)
                held.append((windows, np.full(n, k), weights[k] * used / WINDOW))
                size, seen = size + n, seen + n
                if passes == 1 and size >= MIXED:
                    learn(1)
                    held, size = [], 0
        if held:
            learn(passes)
        if seen:
            v = np.round(flat(net.p).astype(np.float64) * FIXED).astype(np.int64) * seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v),
                 pa.array(np.full(len(v), seen))], names=["k", "v", "n"])
    return run


def fit(df: DataFrame, seed: int = 7, **cols) -> dict:
    """The network fitted to all labelled rows of ``df`` that are not held out. Only its
    parameters (about 4,000 numbers) reach the driver. A single task passes its windows
    several times, fewer than ``2 * STEP * STEPS`` of them."""
    rows = labelled(df, False, **cols)
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.sum(F.ceil(
        F.octet_length("t") / WINDOW)).alias("n")).collect()}
    labels, total = sorted(counts), sum(counts.values())
    if not labels:
        return {"labels": []}
    weights = np.array([min(MOST_WEIGHT, total / (len(labels) * counts[y])) for y in labels])
    parts = max(1, total // (STEP * STEPS))
    passes = 1 if parts > 1 else -(-STEPS // -(-total // STEP))
    p, _ = started(labels, seed)
    batches_of(df.sparkSession, 256)
    for at, (low, high) in enumerate(ROUNDS if parts > 1 else [(0, SLOTS)]):
        slot = F.pmod("h", F.lit(SLOTS))
        got = (rows.filter((slot >= low) & (slot < high)).repartition(parts, "h")
               .sortWithinPartitions("h", "t", "y")
               .mapInArrow(trimmed(_trained(p, labels, weights, seed + at, passes)),
                           "k int, v long, n long")
               .groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"),
                                 F.sum("n").alias("n")).collect())
        if got:
            values = np.zeros(len(got))
            for r in got:
                values[r["k"]] = int(r["v"]) / r["n"] / FIXED
            p = shaped(p, values)
    return {"labels": labels, **p}


def compiled(model: dict) -> dict:
    """Filters over embeddings as sums of table rows: one table for each pair of bytes
    and one for a single byte, so that a width of 2, 3 or 4 takes one or two look-ups."""
    E = model["E"]
    per = {w: [E @ model[f"W{w}"][j * EMBED:(j + 1) * EMBED] for j in range(w)] for w in WIDTHS}
    pair = lambda a, b: np.ascontiguousarray(
        (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS))
    tables = {w: [(j, pair(per[w][j], per[w][j + 1])) if j + 1 < w else (j, per[w][j])
                  for j in range(0, w, 2)] for w in WIDTHS}
    return {**{k: model[k] for k in ("labels", "V", "b")}, "tables": tables,
            "c": np.concatenate([model[f"c{w}"] for w in WIDTHS])}


def probabilities(net: dict, x: np.ndarray) -> np.ndarray:
    """Class probabilities of each window (rows of WINDOW bytes)."""
    two = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
    pooled = []
    for w in WIDTHS:
        n, a = WINDOW - w + 1, None
        for j, t in net["tables"][w]:
            got = t.take((two if len(t) > 256 else x)[:, j:j + n], axis=0)
            a = got if a is None else np.add(a, got, out=a)
        pooled.append(a.max(axis=1))
    logit = np.maximum(np.concatenate(pooled, axis=1) + net["c"], 0) @ net["V"] + net["b"]
    e = np.exp(logit - logit.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def text_scores(net: dict, texts: list[str]) -> list[tuple[str, float]]:
    """(label, score) of whole texts; windows of many texts share a block."""
    cut = [to_windows(t.encode("utf-8", "surrogatepass")) for t in texts]
    owner = np.concatenate([np.full(len(u), k) for k, (_, u) in enumerate(cut)])
    x = np.concatenate([a for a, _ in cut])
    used = np.concatenate([u for _, u in cut]).astype(np.float64)
    sums = np.zeros((len(texts), len(net["labels"])))
    for at in range(0, len(x), BLOCK):
        part = slice(at, at + BLOCK)
        np.add.at(sums, owner[part], probabilities(net, x[part]) * used[part, None])
    sums /= sums.sum(axis=1, keepdims=True)
    best = sums.argmax(axis=1)
    return [(net["labels"][b], float(min(1.0, s[b]))) for b, s in zip(best, sums)]


def _scored(net_bc):
    def run(batches):
        net = net_bc.value
        for batch in batches:
            texts = batch.column("t").to_pylist()
            ok = batch.column("letters").to_pylist()
            pick = [k for k, x in enumerate(ok) if x and net["labels"]]
            label, score = ["und"] * len(texts), [0.0] * len(texts)
            for at in range(0, len(pick), 64):
                part = pick[at:at + 64]
                for k, (y, s) in zip(part, text_scores(net, [texts[k] for k in part])):
                    label[k], score[k] = y, s
            keep = [batch.column(n) for n in batch.schema.names if n not in ("t", "letters")]
            names = [n for n in batch.schema.names if n not in ("t", "letters")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(label, pa.string()), pa.array(score, pa.float64())],
                names=[*names, "lang_pred", "score"])
    return run


def identify(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (a struct of the whole input row), ``lang_pred`` and ``score``.
    The network goes to the tasks as a broadcast of fixed size (about 13 MB)."""
    spark = df.sparkSession
    batches_of(spark, 256)
    net = compiled(model) if model["labels"] else model
    src = df.select(F.struct("*").alias("row"), F.coalesce(
        F.col(f"`{text_col}`"), F.lit("")).alias("t")).withColumn(
        "letters", F.col("t").rlike(r"\p{L}"))
    schema = src.select("row").schema.add("lang_pred", "string").add("score", "double")
    return src.mapInArrow(trimmed(_scored(spark.sparkContext.broadcast(net))), schema)


def calibrated(df: DataFrame, model: dict, most: float, **cols) -> float:
    """A score that labelled texts reach: a little below what all those that the network never
    saw (held out; one in a hundred may be lower) score, in whole SCORE_STEPS, and never above
    ``most``. 0, so that nothing is rejected by its score, where there is no such text."""
    if not model["labels"]:
        return 0.0
    counts = sorted(map(tuple, identify(labelled(df, True, **cols).select("t"), model, "t")
                        .groupBy(F.floor(F.col("score") * SCORE_STEPS)).count().collect()))
    rank = (sum(n for _, n in counts) - 1) // 100
    for step, n in counts:
        if rank < n:
            return min(most, 0.9 * step / SCORE_STEPS)
        rank -= n
    return 0.0


def keep_languages(df: DataFrame, model: dict, languages=None, min_score: float = 0.0,
                   text_col: str = "text") -> DataFrame:
    """Rows whose text is identified as one of ``languages`` (None: any learned one) with
    at least ``min_score``; others, ``und`` included, go. Rows come back unchanged."""
    got = identify(df, model, text_col)
    ok = (F.col("lang_pred") != "und") if languages is None else F.col("lang_pred").isin(
        *languages)
    return got.filter(ok & (F.col("score") >= min_score)).select("row.*")


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """Fit on the rows not held out, then label every row of ``df``."""
    got = identify(df.select(F.col(id_col), F.col(text_col)),
                   fit(df, id_col=id_col, text_col=text_col, lang_col=lang_col), text_col)
    return got.select(F.col("row").getField(id_col).alias(id_col),
                      held_out("row." + id_col).alias("held_out"), "lang_pred", "score")
