"""Report view traps on inline rows: LEFT joins with unknown keys, DISTINCT of
re-delivered rows, terminal-version fan-out vs as-of, latest-day window."""

from __future__ import annotations

import datetime as dt

from conftest import view_rows

from cardwatch.operators import fraud_report, report_view
from cardwatch.schemas import OPEN_END

SEED = dt.datetime(1900, 1, 1)


def dims(spark):
    cards = spark.createDataFrame([("C1", "A1", SEED, OPEN_END, 0)],
                                  "card_num string, account string, effective_from timestamp_ntz,"
                                  " effective_to timestamp_ntz, deleted_flg int")
    accounts = spark.createDataFrame(
        [("A1", dt.date(2030, 1, 1), "K1", SEED, OPEN_END, 0)],
        "account string, valid_to date, client string, effective_from timestamp_ntz,"
        " effective_to timestamp_ntz, deleted_flg int")
    clients = spark.createDataFrame(
        [("K1", "Ivanov", "Ivan", None, "P1", None, "+7", SEED, OPEN_END, 0)],
        "client_id string, last_name string, first_name string, patronymic string,"
        " passport_num string, passport_valid_to date, phone string,"
        " effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg int")
    # T1 moved from Moscow to Kazan on 2024-01-02; T2 only ever in Omsk
    terminals = spark.createDataFrame(
        [("T1", "Moscow", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 59, 59), 0),
         ("T1", "Kazan", dt.datetime(2024, 1, 2), OPEN_END, 0),
         ("T2", "Omsk", dt.datetime(2024, 1, 1), OPEN_END, 0)],
        "terminal_id string, terminal_city string, effective_from timestamp_ntz,"
        " effective_to timestamp_ntz, deleted_flg int")
    return cards, accounts, clients, terminals


def facts(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame(
        [(i, dt.datetime.fromisoformat(t), "SUCCESS", c, Decimal("1.00"), "PAYMENT", term,
          dt.date.fromisoformat(t[:10])) for i, t, c, term in rows],
        "trans_id string, trans_date timestamp_ntz, oper_result string, card_num string,"
        " amt decimal(12,2), opertype string, terminal string, trans_dt date")


def test_left_joins_keep_unknown_card_and_terminal(spark):
    f = facts(spark, [("1", "2024-01-03 10:00:00", "C9", "T9")])
    (r,) = report_view(f, *dims(spark), day=None).collect()
    assert (r["trans_id"], r["account"], r["passport_num"], r["terminal_city"]) == \
        ("1", None, None, None)


def test_fio_is_null_when_a_name_part_is_null(spark):
    f = facts(spark, [("1", "2024-01-03 10:00:00", "C1", "T2")])
    (r,) = report_view(f, *dims(spark), day=None).collect()
    assert r["fio"] is None and r["passport_num"] == "P1" and r["terminal_city"] == "Omsk"
    (r,) = report_view(f, *dims(spark), day=None, fio_parts=("last_name", "first_name")
                       ).collect()
    assert r["fio"] == "Ivanov Ivan"


def test_redelivered_rows_collapse_and_history_fans_out(spark):
    f = facts(spark, [("1", "2024-01-03 10:00:00", "C1", "T2"),
                      ("1", "2024-01-03 10:00:00", "C1", "T2"),       # same row loaded twice
                      ("2", "2024-01-03 11:00:00", "C1", "T1")])
    all_versions = report_view(f, *dims(spark), day=None)
    got = sorted((r["trans_id"], r["terminal_city"]) for r in all_versions.collect())
    assert got == [("1", "Omsk"), ("2", "Kazan"), ("2", "Moscow")]
    as_of = report_view(f, *dims(spark), day=None, history="as_of")
    got = sorted((r["trans_id"], r["terminal_city"]) for r in as_of.collect())
    assert got == [("1", "Omsk"), ("2", "Kazan")]


def test_latest_day_is_half_open(spark):
    f = facts(spark, [("1", "2024-01-02 23:59:59", "C1", "T2"),
                      ("2", "2024-01-03 00:00:00", "C1", "T2"),
                      ("3", "2024-01-03 23:59:59", "C1", "T2")])
    got = sorted(r["trans_id"] for r in report_view(f, *dims(spark)).collect())
    assert got == ["2", "3"]


def test_no_broadcast_path_gives_same_rows(spark):
    f = facts(spark, [("1", "2024-01-03 10:00:00", "C1", "T1"),
                      ("2", "2024-01-03 10:05:00", "C9", "T2")])
    a = sorted(tuple(r) for r in report_view(f, *dims(spark), day=None).collect())
    b = sorted(tuple(r) for r in report_view(f, *dims(spark), day=None,
                                             broadcast_rows=0).collect())
    assert a == b


def test_fraud_report_is_invariant_to_input_partitioning(spark):
    import random
    rnd = random.Random(3)
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for i in range(400):
        rows.append(dict(trans_id=f"{i:05d}",
                         trans_date=t0 + dt.timedelta(seconds=rnd.randint(0, 86400)),
                         oper_result=rnd.choice(["SUCCESS", "REJECT"]),
                         opertype=rnd.choice(["PAYMENT", "WITHDRAW"]),
                         account=f"A{rnd.randint(1, 4)}", passport_num=f"P{rnd.randint(1, 4)}",
                         valid_to=dt.date(2023, 12, 31) if rnd.random() < 0.2 else None,
                         fio="f", phone="p", terminal_city=rnd.choice(["X", "Y"]),
                         amt=rnd.randint(1, 100)))
    v = view_rows(spark, rows)
    bl = spark.createDataFrame([("P2",)], "passport_num string")
    want = sorted(tuple(r) for r in fraud_report(v, bl, max_span_seconds=7200).collect())
    got = sorted(tuple(r) for r in fraud_report(v.repartition(7).sortWithinPartitions("amt"),
                                                bl, max_span_seconds=7200).collect())
    assert got == want and len(want) > 0


# --- as-of: one fact join against three -------------------------------------------------------
def as_of_by_three_joins(facts, cards, accounts, clients):
    """Plain nested LEFT joins by transaction time, in Python."""
    def live(rows, key, when):
        return [r for r in rows if key is not None and r[0] == key and r[-1] == 0
                and r[-3] <= when and when - dt.timedelta(seconds=1) < r[-2]] or [None]
    out = []
    for tid, when, card in facts:
        for k in live(cards, card, when):
            for a in live(accounts, k and k[1], when):
                for c in live(clients, a and a[2], when):
                    out.append((tid, a and a[0], a and a[1], a and a[2], c and c[1]))
    return sorted(out, key=str)


def test_as_of_with_overlapping_touching_and_missing_versions(spark):
    import random

    from cardwatch.operators.report import owner_as_of, report_view
    r = random.Random(12)
    t0, end = dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)
    day = dt.timedelta(days=1)

    def versions(key, attrs):
        rows, at = [], r.randint(0, 3)
        for _ in range(r.randint(0, 4)):
            until = at + r.randint(0, 4)
            to = end if r.random() < 0.2 else t0 + until * day - dt.timedelta(seconds=1)
            rows.append((key, *attrs(), t0 + at * day, to, int(r.random() < 0.1)))
            at = until + r.choice([-1, 0, 0, 1])       # overlap, touch or leave a hole
        return rows

    maybe = lambda x: None if r.random() < 0.1 else x
    cards = [v for k in range(30) for v in versions(f"C{k}", lambda: (maybe(f"A{r.randint(0, 9)}"),))]
    accounts = [v for k in range(10) for v in versions(
        f"A{k}", lambda: (dt.date(2024, 1, r.randint(1, 28)), maybe(f"P{r.randint(0, 5)}")))]
    clients = [v for k in range(6) for v in versions(f"P{k}", lambda: (f"pass{r.randint(0, 99)}",))]
    clients += clients[:2]                              # a version that stands twice
    facts = [(f"t{n}", t0 + dt.timedelta(hours=r.randint(0, 300)), maybe(f"C{r.randint(0, 31)}"))
             for n in range(400)]
    facts += [(f"e{n}", t0 + n * day - dt.timedelta(microseconds=m), f"C{n % 9}")
              for n in range(12) for m in (0, 1, 999_999, 1_000_001)]
    scd = "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg int"
    f = spark.createDataFrame([(a, b, c, None) for a, b, c in facts],
                              "trans_id string, trans_date timestamp_ntz, card_num string, "
                              "terminal string").selectExpr(
        "*", "'SUCCESS' AS oper_result", "CAST(1 AS DECIMAL(12,2)) AS amt", "'PAYMENT' AS opertype")
    k = spark.createDataFrame(cards, f"card_num string, account string, {scd}")
    a = spark.createDataFrame(accounts, f"account string, valid_to date, client string, {scd}")
    c = spark.createDataFrame(clients, f"client_id string, passport_num string, {scd}").selectExpr(
        "*", "CAST(NULL AS DATE) AS passport_valid_to", "'n' AS last_name", "'p' AS phone")
    t = spark.createDataFrame([], f"terminal_id string, terminal_city string, {scd}")
    got = report_view(f, k, a, c, t, day=None, history="as_of", fio_parts=("last_name",),
                      distinct=False)
    rows = sorted(((x["trans_id"], x["account"], x["valid_to"], x["client"], x["passport_num"])
                   for x in got.collect()), key=str)
    assert rows == as_of_by_three_joins(facts, cards, accounts, clients)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join LeftOuter") == 4            # two between dimensions, owner, terminal
    empty = owner_as_of(k.limit(0), a, c, fio_parts=("last_name",))
    assert empty.count() == 0
