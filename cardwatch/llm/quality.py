"""Weakly supervised quality rules, with DataFrame functions only.

Every rule looks at one signal of a whole text and votes good (1), bad (-1) or
abstains (0). Expectation-maximisation over the counts of all documents' vote
patterns estimates, for both classes, how often each rule votes which way (its
accuracy), and the share of good documents; the posterior probability of "good"
then replaces an all-must-pass filter.

Defined cases: a null text counts as empty; a text without words has zero in every
signal, all rules abstain and ``base_failed`` is true. Repeated rows are judged row
by row. An empty table leaves the starting accuracies. Other columns are passed on by
:func:`keep_good` and never read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialize

#: rule -> (signal as numerator, denominator, good when, bad when); bounds are shares.
RULES = {
    "symbols": ("n_symbols", "n_words", ("<=", 0.05), (">=", 0.3)),
    "dup_lines": ("n_dup_lines", "n_lines", ("<=", 0.1), (">=", 0.5)),
    "repeats": ("n_repeat_words", "n_words", ("<=", 0.25), (">=", 0.45)),
    "capitals": ("n_upper", "word_chars", ("<=", 0.2), (">=", 0.4)),
    "shouts": ("n_shouts", "n_words", ("<=", 0.1), (">=", 0.35)),
    "tables": ("n_bars", "n_words", ("<=", 0.02), (">=", 0.15)),
    "long_words": ("word_chars", "n_words", ("<=", 9.0), (">=", 14.0)),
}
SYMBOLS = "#*$%&|<>"
ROUNDS = 25
#: Starting shares: of good documents, and of bad votes among (good, bad) documents.
START_GOOD, START_BAD_VOTES = 0.8, (0.005, 0.3)
#: Added to each vote count, so that no share becomes zero.
SMOOTHING = 1.0
#: The rules are precise rather than complete, and EM stays inside that: bounds of the
#: share of a rule's bad votes among good documents, and among bad ones.
GOOD_BOUNDS, BAD_BOUNDS = (1e-4, 0.005), (0.05, 0.6)
SIGNALS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _n(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def signals(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per document: a struct ``row`` of all input columns, and the signals."""
    base = df.select(F.struct("*").alias("row"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    split = base.select(
        "row", "t",
        F.filter(F.split("t", SPACE), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("ls"))
    last = F.size("w") - 3
    hashed = split.select("row", "t", "w", "ls", F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("h"))
    # Windows of three words with their place, in the order of their hashes: equal windows
    # become neighbours, without comparing all pairs. A text whose hashes all differ has
    # no equal windows and needs no sort.
    counted = hashed.select(
        "row", "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).cast("long")
        .alias("n_shouts"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        (F.size("w") - F.size(F.array_remove("w", "|"))).cast("long").alias("n_bars"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform(
            "h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).alias("ws"))
    rest = [c for c in counted.columns if c not in ("w", "ws")]

    def same(x, y):  # equal hashes, and, lest they collide, equal words
        words = F.lit(True)
        for k in range(3):
            words = words & (F.get("w", x["p"] + k) == F.get("w", y["p"] + k))
        return (x["h"] == y["h"]) & words

    twice = counted.select(*rest, F.sort_array(F.transform(
        F.filter("ws", lambda x, i: same(x, F.get("ws", i - 1)) | same(x, F.get("ws", i + 1))),
        lambda x: x["p"])).alias("ps"))
    covered = F.aggregate(
        F.transform("ps", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("ps", i + 1) - p,
                                                                     F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    # The partition's number, which is not deterministic, keeps the optimizer from pushing
    # filters on the verdict below this point, where each use of a signal would become a
    # copy of its whole expression. The verdict uses it, or it would be pruned.
    return twice.select(*rest, _n(covered).alias("n_repeat_words"),
                        F.spark_partition_id().alias("part")).withColumn(
        "base_failed", (F.col("part") >= 0) & (
            (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def vote(rule: str) -> Column:
    num, den, (g_op, g), (b_op, b) = RULES[rule]
    share = F.when(F.col(den) > 0, F.col(num) / F.col(den))
    holds = {"<=": lambda x: share <= x, ">=": lambda x: share >= x}
    return F.when(holds[g_op](g), 1).when(holds[b_op](b), -1).otherwise(0)


def fit(signal_rows: DataFrame) -> dict:
    """EM over the counts of vote patterns. There are at most 3 ** len(RULES) patterns,
    whatever the number of documents; only their counts come to the driver."""
    patterns = [tuple(r) for r in signal_rows.groupBy(
        *[vote(r).alias(r) for r in RULES]).count().collect()]
    return em(sorted(patterns))


def em(patterns: list[tuple], rounds: int = ROUNDS) -> dict:
    """``patterns``: a vote of each rule, then the number of documents."""
    good, k = START_GOOD, len(RULES)
    # bad_vote[c][j]: share of bad votes of rule j when it votes, in class c (0 good, 1 bad)
    bad_vote = [[START_BAD_VOTES[0]] * k, [START_BAD_VOTES[1]] * k]
    for _ in range(rounds):
        total = [SMOOTHING, SMOOTHING]
        votes = [[2 * SMOOTHING] * k, [2 * SMOOTHING] * k]
        bad = [[START_BAD_VOTES[c] * 2 * SMOOTHING] * k for c in (0, 1)]
        for *v, n in patterns:
            p = posterior_of(v, good, bad_vote)
            for c, share in ((0, p * n), (1, (1 - p) * n)):
                total[c] += share
                for j, x in enumerate(v):
                    if x:
                        votes[c][j] += share
                        bad[c][j] += share * (x < 0)
        good = total[0] / sum(total)
        bad_vote = [[min(hi, max(lo, bad[c][j] / votes[c][j])) for j in range(k)]
                    for c, (lo, hi) in ((0, GOOD_BOUNDS), (1, BAD_BOUNDS))]
    return {"good": good, "bad_vote": bad_vote}


def posterior_of(v, good, bad_vote) -> float:
    z = math.log(good / (1 - good))
    for j, x in enumerate(v):
        if x:
            a, b = bad_vote[0][j], bad_vote[1][j]
            z += math.log(a / b) if x < 0 else math.log((1 - a) / (1 - b))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def posterior(model: dict) -> Column:
    """The posterior probability of a good document, from its votes."""
    good, (a, b) = model["good"], model["bad_vote"]
    z = F.lit(math.log(good / (1 - good)))
    for j, rule in enumerate(RULES):
        v = vote(rule)
        z = z + (F.when(v < 0, math.log(a[j] / b[j]))
                 .when(v > 0, math.log((1 - a[j]) / (1 - b[j]))).otherwise(0.0))
    return 1 / (1 + F.exp(-z))


def judged(signal_rows: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    return signal_rows.withColumn("quality", F.round(posterior(model), 4)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.5) -> DataFrame:
    """Signals, base rule, posterior and verdict per row. The signals of all rows (some
    numbers a row, no text) are written once; EM and the verdict both read them."""
    s = signals(df, text_col)
    s = s.select(F.col("row").getField(id_col).alias(id_col), *s.columns[1:]).drop("part")
    s = materialize(s, "quality_signals")
    return judged(s, fit(s), threshold)


def keep_good(df: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` with a good verdict, unchanged. The signals are computed in the
    fitting pass and again in the filtering one: that moves no text."""
    s = signals(df, text_col)
    return judged(s, fit(s), threshold).filter("kept").select("row.*")
