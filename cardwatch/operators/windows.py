"""Ordered look-back (``lag``) per account without sending a hot account to
one task.

A plain ``Window.partitionBy(account)`` sends every row of an account to one
task; the NULL account (all unknown cards) or one busy merchant account can
hold a large share of a day. :func:`with_exact_lags` numbers the rows of such
keys across tasks and runs the window over equal runs of numbers, giving
exactly the lags of the unsplit window. :func:`with_lags` is the plain window,
kept as the baseline the split version is tested against.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast


def total_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """``order``, then every other column: rows that tie (one transaction in several
    cities, a re-delivered id) have one order wherever they are sorted."""
    return [*order, *[c for c in df.columns if c not in order]]


def with_lags(df: DataFrame, lags: dict[str, tuple[str | Column, int]], *,
              partition: Sequence[str] = ("account",),
              order: Sequence[str] = ("trans_date", "trans_id")) -> DataFrame:
    """``name = lag(expr, offset)`` over one unsplit window (baseline form:
    all lags share one Exchange, one Sort and one Window operator)."""
    w = Window.partitionBy(*partition).orderBy(*total_order(df, order))
    return df.select("*", *[F.lag(c, n).over(w).alias(name) for name, (c, n) in lags.items()])


# --- exact look-back for any distance, hot keys split ----------------------------------
# A key with more rows than this (per call) is split into runs of this many rows.
# Override with `cardwatch.window.hotRows`.
DEFAULT_HOT_ROWS = 2_000_000
HOT_ROWS_CONF = "cardwatch.window.hotRows"
# Up to so many hot keys are broadcast.
BROADCAST_KEYS = 1000


def _hot_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return int(value) if value is not None else DEFAULT_HOT_ROWS


def numbered(df: DataFrame, order: Sequence[str], name: str, parts: int) -> DataFrame:
    """``df`` with ``_number``: 0, 1, 2, ... by ``order`` over all tasks.

    Rows are range partitioned and sorted by the whole order (and a salt, so that equal rows
    part, too) and written once; a row's number is its place in its partition plus the sizes of
    the partitions before, one number each."""
    from .. import config
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    rows = config.materialize(
        salted.repartitionByRange(parts, *order, "_salt").sortWithinPartitions(*order, "_salt")
        .drop("_salt").withColumn("_at", F.monotonically_increasing_id()), name)
    task = F.shiftright("_at", 33)
    sizes = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_start"))
    # One row a partition: at most ``parts``.
    return (rows.join(broadcast(starts), task == F.col("_task"))
            .withColumn("_number", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_at", "_task", "_start"))


def with_exact_lags(df: DataFrame, lags: dict[str, tuple[str | Column, int]], *,
                    partition: Sequence[str] = ("account",),
                    order: Sequence[str] = ("trans_date", "trans_id"),
                    hot_rows: int | None = None) -> DataFrame:
    """``lag`` columns identical to an unsplit ``Window.partitionBy(partition)``,
    without sending a hot key to one task.

    1. Where the frame has no more than ``hot_rows`` rows, or a pre-aggregated count per key
       finds no hot key (more than that), the plain window is used; so it is for all other
       keys. The hot-key table is broadcast behind a count of its rows.
    2. The rows of hot keys get numbers by (key, order) across tasks: a burst, one second or
       NULL times are split like anything else.
    3. One window runs over each run of ``hot_rows`` numbers. The last K rows of a run
       (K = largest offset) are copied to the next as context, and a lag that would reach into
       another key's rows is NULL.
    """
    hot = hot_rows or _hot_rows(df)
    order = total_order(df, order)
    part = list(partition)
    if df.count() <= hot:
        return with_lags(df, lags, partition=part, order=order)
    keys = (df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot)
              .select(*[F.col(c).alias(f"_h_{c}") for c in part], "_n"))
    n_hot, n_rows = keys.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if n_hot == 0:
        return with_lags(df, lags, partition=part, order=order)
    from .. import config
    # Hot keys are few (at most rows / hot_rows): written once, so the count is not repeated.
    keys = config.materialize(keys.drop("_n"), "hot_keys")
    on = None
    for c in part:
        e = F.col(c).eqNullSafe(F.col(f"_h_{c}"))
        on = e if on is None else on & e
    few = broadcast(keys) if n_hot <= BROADCAST_KEYS else keys
    cold = with_lags(df.join(few, on, "left_anti"), lags, partition=part, order=order)

    k = max(off for _, off in lags.values())
    size = max(hot, k)
    parts = max(-(-n_rows // size),
                int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = numbered(df.join(few, on, "left_semi"), [*part, *order], "hot_rows", parts)
    run = F.floor(F.col("_number") / size)
    context = (F.col("_number") % size) >= size - k
    dealt = (rows.withColumn("_run", run)
             .withColumn("_for", F.explode(F.when(context, F.array("_run", F.col("_run") + 1))
                                           .otherwise(F.array("_run")))))
    w = Window.partitionBy("_for").orderBy("_number")
    same = {}
    for off in {off for _, off in lags.values()}:
        cond = F.lag("_number", off).over(w).isNotNull()
        for c in part:
            cond = cond & F.lag(c, off).over(w).eqNullSafe(F.col(c))
        same[off] = cond
    hot_part = (dealt.select("*", *[F.when(same[off], F.lag(c, off).over(w)).alias(name)
                                    for name, (c, off) in lags.items()])
                .filter(F.col("_for") == F.col("_run")).select(*cold.columns))
    return cold.unionByName(hot_part)
