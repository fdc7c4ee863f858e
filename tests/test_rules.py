"""Rule semantics on inline rows: the traps the generated tables cannot show."""

from __future__ import annotations

from conftest import view_rows

from cardwatch.operators import (fraud_report, rule_account, rule_brute_force, rule_cities,
                                 rule_hit_counts, rule_passport)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def base(**kw):
    r = dict(oper_result="SUCCESS", opertype="PAYMENT", account="A1", passport_num="P1",
             fio="F", phone="T", terminal_city="X", amt=10)
    r.update(kw)
    return r


def test_account_expiry_counts_from_midnight_after_valid_to(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-01-10 23:59:59", valid_to="2024-01-10"),
        base(trans_id="2", trans_date="2024-01-11 00:00:00", valid_to="2024-01-10",
             passport_num="P2"),
        base(trans_id="3", trans_date="2024-01-12 10:00:00", valid_to=None, passport_num="P3"),
        base(trans_id="4", trans_date="2024-01-12 10:00:00", valid_to="2024-01-01",
             passport_num="P4", oper_result="REJECT"),
    ])
    out = rule_account(v)
    assert rows(out, "passport", "event_type") == [("P2", "ACCOUNT")]


def test_account_first_hit_per_passport_takes_fio_from_that_row(spark):
    v = view_rows(spark, [
        base(trans_id="9", trans_date="2024-01-12 10:00:00", valid_to="2024-01-01", fio="late"),
        base(trans_id="5", trans_date="2024-01-11 10:00:00", valid_to="2024-01-01", fio="early",
             phone="p-early"),
        base(trans_id="6", trans_date="2024-01-11 10:00:00", valid_to="2024-01-01", fio="tie"),
    ])
    (r,) = rule_account(v).collect()
    assert (r["fio"], r["phone"]) == ("early", "p-early")  # tie on time broken by trans_id


def test_passport_precedence_expired_any_result_blacklist_needs_success(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-02-01 10:00:00", passport_num="EXP",
             passport_valid_to="2024-01-01", oper_result="REJECT"),
        base(trans_id="2", trans_date="2024-02-01 10:00:00", passport_num="BL_REJ",
             oper_result="REJECT"),
        base(trans_id="3", trans_date="2024-02-01 10:00:00", passport_num="BL_OK"),
        base(trans_id="4", trans_date="2024-02-01 10:00:00", passport_num="CLEAN",
             passport_valid_to="2030-01-01"),
        base(trans_id="5", trans_date="2024-02-01 10:00:00", passport_num=None),
    ])
    bl = spark.createDataFrame([("BL_REJ",), ("BL_OK",), (None,)], "passport_num string")
    out = rule_passport(v, bl)
    assert rows(out, "passport") == [("BL_OK",), ("EXP",)]


def test_cities_strict_gap_and_null_city(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-01-01 10:00:00", terminal_city="A"),
        base(trans_id="2", trans_date="2024-01-01 11:00:00", terminal_city="B"),   # 3600 s
        base(trans_id="3", trans_date="2024-01-01 11:59:59", terminal_city="C"),   # 3599 s
        base(trans_id="4", trans_date="2024-01-01 12:00:00", terminal_city=None),
        base(trans_id="5", trans_date="2024-01-01 12:00:01", terminal_city="D"),   # prev NULL
    ])
    (r,) = rule_cities(v).collect()
    assert str(r["event_dt"]) == "2024-01-01 11:59:59"


def test_cities_partitioned_by_account_and_ordered_by_time(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-01-01 10:00:00", terminal_city="A", account="X"),
        base(trans_id="2", trans_date="2024-01-01 10:10:00", terminal_city="B", account="Y",
             passport_num="P2"),
        base(trans_id="3", trans_date="2024-01-01 10:20:00", terminal_city="A", account="X"),
    ])
    assert rule_cities(v).count() == 0


def test_cities_null_account_is_one_partition(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-01-01 10:00:00", terminal_city="A", account=None,
             passport_num=None),
        base(trans_id="2", trans_date="2024-01-01 10:10:00", terminal_city="B", account=None,
             passport_num=None),
    ])
    assert rows(rule_cities(v), "passport") == [(None,)]


def chain(start="2024-01-01 10:00:00", amts=(500, 400, 300, 200),
          res=("REJECT", "REJECT", "REJECT", "SUCCESS"), gaps=(300, 300, 300),
          last_type="WITHDRAW", account="A1", first_id=1):
    import datetime as dt
    t = dt.datetime.fromisoformat(start)
    out = []
    for i, (a, r) in enumerate(zip(amts, res)):
        if i:
            t = t + dt.timedelta(seconds=gaps[i - 1])
        out.append(base(trans_id=f"{first_id + i:04d}", trans_date=t.isoformat(sep=" "),
                        amt=a, oper_result=r, account=account,
                        opertype=last_type if i == len(amts) - 1 else "PAYMENT"))
    return out


def test_brute_force_default_span_is_strict_1200_seconds(spark):
    hit = chain(gaps=(400, 400, 399))               # 1199 s
    miss = chain(gaps=(400, 400, 400), account="A2", first_id=10)  # 1200 s
    out = rule_brute_force(view_rows(spark, hit + miss))
    assert out.count() == 1


def test_brute_force_needs_falling_amounts_rejects_and_opertype(spark):
    v = view_rows(spark,
                  chain(amts=(500, 400, 400, 200))                                  # not strict
                  + chain(account="B", first_id=10, res=("REJECT", "SUCCESS", "REJECT", "SUCCESS"))
                  + chain(account="C", first_id=20, last_type="DEPOSIT")
                  + chain(account="D", first_id=30)[1:]                             # only three
                  + chain(account="E", first_id=40))                                # the hit
    out = rule_brute_force(v)
    assert out.count() == 1


def test_brute_force_one_row_per_hit(spark):
    # falling amounts, results R R R S R R R S: two hits in one account
    res = ("REJECT", "REJECT", "REJECT", "SUCCESS") * 2
    rows_ = chain(amts=(900, 800, 700, 600, 500, 400, 300, 200), res=res, gaps=(60,) * 7)
    out = rule_brute_force(view_rows(spark, rows_))
    assert out.count() == 2


def test_fraud_report_union_and_counts(spark):
    v = view_rows(spark, [
        base(trans_id="1", trans_date="2024-01-11 00:00:00", valid_to="2024-01-10",
             passport_valid_to="2024-01-01", terminal_city="A"),
        base(trans_id="2", trans_date="2024-01-11 00:10:00", terminal_city="B"),
    ] + chain(account="Z", first_id=100))
    bl = spark.createDataFrame([], "passport_num string")
    rep = fraud_report(v, bl)
    counts = dict((r["event_type"], r["hits"]) for r in rule_hit_counts(rep).collect())
    assert counts == {"ACCOUNT": 1, "PASSPORT": 1, "CITIES": 1, "BRUTE_FORCE": 1}
    assert rep.columns == ["event_dt", "passport", "fio", "phone", "event_type"]


def test_lookback_finds_chains_across_midnight_but_reports_the_day_only(spark):
    import datetime as dt
    from cardwatch.operators import report_view
    from test_report import dims, facts
    f = facts(spark, [("1", "2024-01-02 23:50:00", "C1", "T2"),     # Omsk
                      ("2", "2024-01-03 00:10:00", "C1", "T1"),     # Kazan, 20 min later
                      ("3", "2024-01-02 10:00:00", "C1", "T1"),
                      ("4", "2024-01-02 10:30:00", "C1", "T2")])    # yesterday's own hit
    bl = spark.createDataFrame([], "passport_num string")
    # as_of: T1 has two city versions, "all" would fan out into a same-instant change
    plain = fraud_report(report_view(f, *dims(spark), history="as_of"), bl)
    assert plain.filter("event_type = 'CITIES'").count() == 0       # source: day D only
    wide = report_view(f, *dims(spark), history="as_of", lookback_days=1)
    rep = fraud_report(wide, bl, since=dt.date(2024, 1, 3))
    (r,) = rep.filter("event_type = 'CITIES'").collect()
    assert str(r["event_dt"]) == "2024-01-03 00:10:00"
