"""Type-2 history as a log: what a series of full snapshots changes, and the state it makes.

:func:`series_log` folds any number of snapshots in one plan. A key that is usual (at most one
row a snapshot and one live row, no NULL attribute) needs no state but its neighbours in the
series: where it appears, changes or disappears follows from the previous and the next snapshot
that has it, so one window over (key, snapshot) finds every event, and snapshots in which
nothing happens to a key leave no row. Other keys (repeated or NULL ids, NULL attributes, whose
comparison depends on the live row) go through :func:`scd2_diff` one snapshot after the other.

The log's rows are ``open`` (a row that starts at its version) and ``close`` (every row of the
key that started at an earlier version and is still open ends). :func:`state_of` reads the
history back: an open row ends at the first later close of its key. Closing a row never
rewrites it, so what a day writes follows what the day changes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import as_timestamp, open_end, prev_second
from ..schemas import OPEN_END
from .scd2 import CHANGED, DELETED, NEW, scd2_diff

OPEN, CLOSE = "open", "close"
#: Columns of the log beside the key and the attributes.
LOG_FIELDS = ("version", "kind", "at", "deleted_flg")


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _events(rows: DataFrame, key: str, attrs: Sequence[str], last: int) -> DataFrame:
    """Of the rows (key, attrs, _step), step 0 being the live rows, those of other keys
    (``_odd``), and of usual keys those at which something starts (``_start``: new or changed)
    or after which the key is missing (``_gone``)."""
    order = Window.partitionBy(key).orderBy("_step")
    whole = Window.partitionBy(key)
    same_step = F.coalesce(F.lag("_step").over(order) == F.col("_step"), F.lit(False))
    odd = same_step | _any([F.col(a).isNull() for a in attrs])
    before, after = F.lag("_step").over(order), F.lead("_step").over(order)
    differs = _any([F.lag(a).over(order) != F.col(a) for a in attrs])
    step = F.col("_step")
    start = (F.when((step > 0) & (before.isNull() | (before < step - 1)), F.lit(NEW))
             .when((step > 0) & differs, F.lit(CHANGED)))
    gone = (step < last) & (after.isNull() | (after > step + 1))
    keyed = (rows.filter(F.col(key).isNotNull())
             .withColumns({"_o": odd.cast("int"), "_start": start, "_gone": gone})
             .withColumn("_odd", F.max("_o").over(whole) == 1).drop("_o")
             .filter(F.col("_odd") | F.col("_start").isNotNull() | F.col("_gone")))
    none = rows.filter(F.col(key).isNull()).select(
        "*", F.lit(None).cast("string").alias("_start"), F.lit(False).alias("_gone"),
        F.lit(True).alias("_odd"))
    return keyed.unionByName(none)


def _log_rows(rows: DataFrame, key: str, attrs: Sequence[str], step: Column, kind: str,
              deleted: int = 0) -> DataFrame:
    return rows.select(key, *attrs, step.alias("_step"), F.lit(kind).alias("kind"),
                       F.lit(deleted).alias("deleted_flg"))


def _odd_log(live: DataFrame, snapshots: DataFrame, key: str, attrs: Sequence[str], last: int,
             close_tombstones: bool) -> list[DataFrame]:
    """The log of unusual keys: one snapshot after the other."""
    parts = []
    for k in range(1, last + 1):
        snap = snapshots.filter(F.col("_step") == k).withColumn("file_date", F.lit(k))
        diff = config.materialize(scd2_diff(live, snap, key, attrs), "scd2_diff")
        closing = diff.filter(F.col("change_type").isin(
            [CHANGED, DELETED] + ([NEW] if close_tombstones else []))).select(key).distinct()
        opened = diff.filter(F.col("change_type").isin(NEW, CHANGED)).select(key, *attrs)
        parts += [_log_rows(opened, key, attrs, F.lit(k), OPEN),
                  _log_rows(diff.filter(F.col("change_type") == DELETED), key, attrs, F.lit(k),
                            OPEN, 1),
                  _log_rows(closing.filter(F.col(key).isNotNull()).select(
                      key, *[F.lit(None).cast(snapshots.schema[a].dataType).alias(a)
                             for a in attrs]), key, attrs, F.lit(k), CLOSE)]
        live = config.materialize(live.join(closing, key, "left_anti").unionByName(opened),
                                  "scd2_live")
    return parts


def series_log(live: DataFrame, snapshots: DataFrame, dates: Sequence[dt.date],
               versions: Sequence[int], key: str, attrs: Sequence[str], *,
               close_tombstones: bool = False) -> DataFrame:
    """What the snapshots change, as rows (key, attrs, version, kind, at, deleted_flg).

    ``live``: the rows that are live before the first one. ``snapshots``: rows with
    ``file_date``; ``dates`` are the dates of the snapshots to apply, in order, and
    ``versions`` their versions; rows of other dates (or none) are not read. An ``open`` row
    is valid from ``at``; a ``close`` ends rows at ``at``, a second before the snapshot's day.
    The same as one :func:`scd2_merge` after the other, each into the version before it."""
    last = len(dates)
    step = F.create_map(*[x for k, d in enumerate(dates, 1) for x in (F.lit(d), F.lit(k))])
    snap = (snapshots.filter(F.col("file_date").isin(list(dates)))
            .select(key, *attrs, F.element_at(step, F.col("file_date")).alias("_step")))
    rows = live.select(key, *attrs, F.lit(0).alias("_step")).unionByName(snap)
    events = config.materialize(_events(rows, key, attrs, last), "scd2_events")
    usual, odd = events.filter(~F.col("_odd")), events.filter("_odd")
    start, gone = usual.filter("_start IS NOT NULL"), usual.filter("_gone")
    closers = start if close_tombstones else start.filter(F.col("_start") == CHANGED)
    here, later = F.col("_step"), F.col("_step") + 1
    parts = [_log_rows(start, key, attrs, here, OPEN),
             _log_rows(gone, key, attrs, later, OPEN, 1),
             _log_rows(closers, key, attrs, here, CLOSE),
             _log_rows(gone, key, attrs, later, CLOSE)]
    if not odd.isEmpty():
        plain = odd.select(key, *attrs, "_step")
        parts += _odd_log(plain.filter("_step = 0").drop("_step"), plain.filter("_step > 0"),
                          key, attrs, last, close_tombstones)
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    # Versions and days by step, as literals: one a snapshot.
    number = F.create_map(*[x for k, v in enumerate(versions, 1) for x in (F.lit(k), F.lit(v))])
    day = F.create_map(*[x for k, d in enumerate(dates, 1) for x in (F.lit(k), F.lit(d))])
    at = as_timestamp(F.element_at(day, F.col("_step")))
    return log.select(key, *attrs, F.element_at(number, F.col("_step")).alias("version"), "kind",
                      F.when(F.col("kind") == OPEN, at).otherwise(prev_second(at)).alias("at"),
                      "deleted_flg")


def state_of(base: DataFrame, log: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The history that the open rows ``base`` (with ``version``) and a log after them make:
    (key, attrs, effective_from, effective_to, deleted_flg, version). A key has at most one
    close a version, so its list is bounded by the versions in the log."""
    closes = (log.filter((F.col("kind") == CLOSE) & F.col(key).isNotNull())
              .groupBy(F.col(key).alias("_key"))
              .agg(F.array_sort(F.collect_set(F.struct("version", "at"))).alias("_closes")))
    opened = log.filter(F.col("kind") == OPEN).select(
        key, *attrs, F.col("at").alias("effective_from"), open_end().alias("effective_to"),
        "deleted_flg", "version")
    rows = base.select(*opened.columns).unionByName(opened)
    ends = F.get(F.filter("_closes", lambda c: c["version"] > F.col("version")), F.lit(0))["at"]
    return (rows.join(closes, F.col(key) == F.col("_key"), "left")
            .withColumn("effective_to", F.coalesce(ends, F.col("effective_to")))
            .select(*opened.columns))


def is_open() -> Column:
    return F.col("effective_to") == F.lit(OPEN_END).cast("timestamp_ntz")


__all__ = ["series_log", "state_of", "is_open", "OPEN", "CLOSE", "LOG_FIELDS"]
