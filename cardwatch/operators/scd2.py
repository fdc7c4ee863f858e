"""Slowly changing (type 2) dimensions maintained from full daily snapshots.

A ``*_HIST`` table holds every version of a row with ``effective_from``,
``effective_to`` (``OPEN_END`` while live) and ``deleted_flg``. A merge never
updates in place: it returns the whole next version of the table, which the
pipeline writes to a new folder (a Parquet table cannot be overwritten by a
plan that is still reading it).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import as_timestamp, open_end, prev_second
from .joins import broadcast_if_small

NEW, CHANGED, DELETED = "new", "changed", "deleted"


def dim_current(hist: DataFrame, as_of: dt.datetime | dt.date | str | Column | None = None
                ) -> DataFrame:
    """Rows live at ``as_of`` (default: the current local timestamp), bounds
    inclusive, tombstones excluded."""
    at = F.localtimestamp() if as_of is None else as_timestamp(as_of)
    return hist.filter(at.between(F.col("effective_from"), F.col("effective_to"))
                       & (F.col("deleted_flg") == 0))


def _differs(attrs: Sequence[str], null_safe: bool) -> Column:
    """Any attribute differs. By default a NULL on either side does not count
    as a change (``a <> b`` is NULL); ``null_safe=True`` counts it."""
    cond = None
    for a in attrs:
        left, right = F.col(f"_s.{a}"), F.col(f"_c.{a}")
        d = ~left.eqNullSafe(right) if null_safe else F.coalesce(left != right, F.lit(False))
        cond = d if cond is None else (cond | d)
    return cond if cond is not None else F.lit(False)


def scd2_diff(current: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], *,
              null_safe: bool = False) -> DataFrame:
    """New, changed and deleted rows of a full snapshot against the live rows,
    from one FULL OUTER join on ``key`` (one shuffle of each side instead of
    two anti joins and an inner join).

    Output: ``key``, ``attrs``, ``file_date`` (NULL for deletions) and
    ``change_type``. New and changed rows carry the snapshot attributes,
    deleted rows the live ones. A snapshot row matching several live rows is
    compared with each (one changed row per differing pair)."""
    s = snapshot.select(key, *attrs, "file_date", F.lit(True).alias("_in_s")).alias("_s")
    c = current.select(key, *attrs, F.lit(True).alias("_in_c")).alias("_c")
    j = s.join(c, F.col(f"_s.{key}") == F.col(f"_c.{key}"), "full_outer")
    in_s, in_c = F.col("_s._in_s").isNotNull(), F.col("_c._in_c").isNotNull()
    change = (F.when(in_s & ~in_c, F.lit(NEW))
               .when(in_s & in_c & _differs(attrs, null_safe), F.lit(CHANGED))
               .when(~in_s & in_c, F.lit(DELETED)))
    pick = [F.when(in_s, F.col(f"_s.{n}")).otherwise(F.col(f"_c.{n}")).alias(n)
            for n in (key, *attrs)]
    return (j.select(*pick, F.col("_s.file_date").alias("file_date"),
                     change.alias("change_type"))
             .filter(F.col("change_type").isNotNull()))


def scd2_merge(hist: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], *,
               snapshot_date: dt.date | str | Column | None = None,
               as_of: dt.datetime | dt.date | str | Column | None = None,
               null_safe: bool = False, close_tombstones: bool = False) -> DataFrame:
    """The next version of ``hist`` after applying one full ``snapshot``.

    With D the snapshot date (default ``max(file_date)`` of the snapshot):
      * every delta is computed from the pre-merge live rows;
      * new rows are inserted from their ``file_date`` (else D), open, live;
      * changed keys: every open row of the key is closed at D - 1 s, and the
        new version is inserted;
      * deleted keys: the open row is closed at D - 1 s and a tombstone with
        the old attributes is inserted from D, open, ``deleted_flg = 1``.
    A key that returns after deletion counts as new; its open tombstone stays
    open (source behaviour) unless ``close_tombstones=True``.
    """
    if snapshot_date is None:
        d = snapshot.select(F.max("file_date")).scalar().cast("timestamp_ntz")
    else:
        d = as_timestamp(snapshot_date)
    current = dim_current(hist, as_of)
    # The day's delta is small next to the dimension and is read three times
    # (closing keys, inserts, tombstones): written once, joined once.
    diff = config.materialize(scd2_diff(current, snapshot, key, attrs, null_safe=null_safe),
                              "scd2_diff")
    closing_types = [CHANGED, DELETED] + ([NEW] if close_tombstones else [])
    # The day's changed/deleted keys: small next to the dimension, so broadcast
    # behind a bounded count and the open rows are not shuffled for the update.
    closing = broadcast_if_small(
        diff.filter(F.col("change_type").isin(closing_types))
            .select(F.col(key).alias("_close_key")).distinct())
    cols = hist.columns
    # Only open rows (effective_to = OPEN_END) can be closed; every closed
    # version passes through untouched, without a shuffle or a join.
    is_open = F.coalesce(F.col("effective_to") == open_end(), F.lit(False))
    closed_rows = hist.filter(~is_open)
    reclosed = (hist.filter(is_open)
                    .join(closing, F.col(key) == F.col("_close_key"), "left")
                    .withColumn("effective_to",
                                F.when(F.col("_close_key").isNotNull(), prev_second(d))
                                 .otherwise(F.col("effective_to")))
                    .select(*cols))
    old = closed_rows.unionByName(reclosed)
    extra = [c for c in cols if c not in (key, *attrs, "effective_from", "effective_to",
                                          "deleted_flg")]
    fillers = [F.lit(None).cast(hist.schema[c].dataType).alias(c) for c in extra]
    inserted = diff.filter(F.col("change_type").isin(NEW, CHANGED)).select(
        key, *attrs, *fillers,
        F.coalesce(F.col("file_date").cast("timestamp_ntz"), d).alias("effective_from"),
        open_end().alias("effective_to"), F.lit(0).alias("deleted_flg"))
    tombstones = diff.filter(F.col("change_type") == DELETED).select(
        key, *attrs, *fillers, d.alias("effective_from"), open_end().alias("effective_to"),
        F.lit(1).alias("deleted_flg"))
    return (old.unionByName(inserted.select(*cols))
               .unionByName(tombstones.select(*cols)))


def first_load(snapshot: DataFrame, key: str, attrs: Sequence[str],
               snapshot_date: dt.date | str | None = None) -> DataFrame:
    """History of a dimension seen for the first time: every row open from D."""
    d = (as_timestamp(snapshot_date) if snapshot_date is not None
         else F.col("file_date").cast("timestamp_ntz"))
    return snapshot.select(key, *attrs, d.alias("effective_from"),
                           open_end().alias("effective_to"), F.lit(0).alias("deleted_flg"))
