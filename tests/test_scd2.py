"""SCD2 merge contract on inline snapshots."""

from __future__ import annotations

import datetime as dt

from cardwatch.operators import dim_current, first_load, scd2_diff, scd2_merge
from cardwatch.schemas import OPEN_END

KEY, ATTRS = "terminal_id", ("terminal_type", "terminal_city")
SNAP = "terminal_id string, terminal_type string, terminal_city string, file_date date"


def snap(spark, day, rows):
    return spark.createDataFrame([(*r, dt.date.fromisoformat(day)) for r in rows], SNAP)


def versions(df):
    return sorted((r["terminal_id"], r["terminal_city"], str(r["effective_from"]),
                   str(r["effective_to"]), r["deleted_flg"]) for r in df.collect())


def merge(hist, s, **kw):
    return scd2_merge(hist, s, KEY, ATTRS, as_of="2100-01-01", **kw)


def test_new_changed_deleted(spark):
    h1 = first_load(snap(spark, "2024-01-01", [("1", "pos", "A"), ("2", "pos", "B"),
                                               ("3", "atm", "C")]), KEY, ATTRS)
    h2 = merge(h1, snap(spark, "2024-01-02", [("1", "pos", "A"), ("2", "pos", "Z"),
                                              ("4", "atm", "D")]))
    o = str(OPEN_END)
    assert versions(h2) == sorted([
        ("1", "A", "2024-01-01 00:00:00", o, 0),
        ("2", "B", "2024-01-01 00:00:00", "2024-01-01 23:59:59", 0),
        ("2", "Z", "2024-01-02 00:00:00", o, 0),
        ("3", "C", "2024-01-01 00:00:00", "2024-01-01 23:59:59", 0),
        ("3", "C", "2024-01-02 00:00:00", o, 1),
        ("4", "D", "2024-01-02 00:00:00", o, 0),
    ])


def test_null_attribute_is_not_a_change_unless_null_safe(spark):
    h1 = first_load(snap(spark, "2024-01-01", [("1", "pos", None)]), KEY, ATTRS)
    s2 = snap(spark, "2024-01-02", [("1", "pos", "A")])
    cur = dim_current(h1, "2024-01-02")
    assert scd2_diff(cur, s2, KEY, ATTRS).count() == 0
    assert [r["change_type"] for r in
            scd2_diff(cur, s2, KEY, ATTRS, null_safe=True).collect()] == ["changed"]


def test_same_snapshot_twice_is_idempotent(spark):
    s = snap(spark, "2024-01-01", [("1", "pos", "A"), ("2", "atm", "B")])
    h1 = first_load(s, KEY, ATTRS)
    h2 = merge(h1, snap(spark, "2024-01-02", [("1", "pos", "A"), ("2", "atm", "B")]))
    assert versions(h2) == versions(h1)


def test_deleted_yesterday_still_absent_changes_nothing(spark):
    h1 = first_load(snap(spark, "2024-01-01", [("1", "pos", "A"), ("2", "pos", "B")]),
                    KEY, ATTRS)
    h2 = merge(h1, snap(spark, "2024-01-02", [("1", "pos", "A")]))
    h3 = merge(h2, snap(spark, "2024-01-03", [("1", "pos", "A")]))
    assert versions(h3) == versions(h2)


def test_return_after_deletion_keeps_tombstone_open_unless_asked(spark):
    h1 = first_load(snap(spark, "2024-01-01", [("1", "pos", "A")]), KEY, ATTRS)
    h2 = merge(h1, snap(spark, "2024-01-02", []))
    back = snap(spark, "2024-01-03", [("1", "pos", "A")])
    h3 = merge(h2, back)
    open_rows = [v for v in versions(h3) if v[3] == str(OPEN_END)]
    assert [v[4] for v in open_rows] == [0, 1]          # new row + open tombstone
    h3c = merge(h2, back, close_tombstones=True)
    open_rows = [v for v in versions(h3c) if v[3] == str(OPEN_END)]
    assert [v[4] for v in open_rows] == [0]
    # a later change closes both open rows (source behaviour)
    h4 = merge(h3, snap(spark, "2024-01-04", [("1", "pos", "Q")]))
    open_rows = [v for v in versions(h4) if v[3] == str(OPEN_END)]
    assert [(v[1], v[4]) for v in open_rows] == [("Q", 0)]


def test_duplicate_ids_in_snapshot_are_all_inserted(spark):
    h1 = first_load(snap(spark, "2024-01-01", [("1", "pos", "A")]), KEY, ATTRS)
    h2 = merge(h1, snap(spark, "2024-01-02", [("1", "pos", "A"), ("2", "x", "B"),
                                              ("2", "x", "C")]))
    assert sum(1 for v in versions(h2) if v[0] == "2") == 2


def test_diff_parts_disjoint_and_one_live_row_per_id(spark):
    h1 = first_load(snap(spark, "2024-01-01", [(str(i), "t", f"c{i % 3}") for i in range(30)]),
                    KEY, ATTRS)
    s2 = snap(spark, "2024-01-05", [(str(i), "t", f"c{i % 4}") for i in range(5, 40)])
    diff = scd2_diff(dim_current(h1, "2024-01-05"), s2, KEY, ATTRS)
    kinds = {}
    for r in diff.collect():
        kinds.setdefault(r[KEY], set()).add(r["change_type"])
    assert all(len(k) == 1 for k in kinds.values())
    h2 = merge(h1, s2)
    live = dim_current(h2, "2024-01-06").groupBy(KEY).count()
    assert live.filter("count > 1").count() == 0
    assert live.count() == 35
