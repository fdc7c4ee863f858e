"""The hot-key split look-back equals the unsplit window: on the lag values
themselves and on every rule hit, with a 60 % hot account and NULL accounts."""

from __future__ import annotations

import datetime as dt
import random

from conftest import view_rows

from cardwatch.operators.rules import (CITY_LAGS, _chain_hits, _chain_lag_spec, _city_hits,
                                       chain_lags, city_lags)
from cardwatch.operators.windows import with_exact_lags, with_lags


def random_view(spark, n=1500, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        account = "HOT" if rnd.random() < 0.6 else (None if rnd.random() < 0.1
                                                   else f"A{rnd.randint(1, 5)}")
        t = t0 + dt.timedelta(seconds=rnd.randint(0, 3 * 86400),
                              microseconds=rnd.randint(0, 999999))
        if rnd.random() < 0.01:
            t = None
        rows.append(dict(trans_id=f"{i:06d}", trans_date=t,
                         oper_result=rnd.choice(["SUCCESS", "REJECT", "REJECT"]),
                         opertype=rnd.choice(["PAYMENT", "WITHDRAW", "DEPOSIT"]),
                         account=account, passport_num=account, fio="f", phone="p",
                         terminal_city=rnd.choice(["A", "B", "C", None]),
                         amt=rnd.randint(1, 1000)))
    return view_rows(spark, rows)


def ids(df):
    return sorted(r["trans_id"] for r in df.select("trans_id").collect())


def test_city_hits_equal_unsplit(spark):
    v = random_view(spark)
    exact = _city_hits(with_lags(v, CITY_LAGS), 3600)
    assert len(ids(exact)) > 10
    for hot in (7, 50, 10**9):
        assert ids(_city_hits(city_lags(v, hot_rows=hot), 3600)) == ids(exact)


def test_chain_hits_equal_unsplit(spark):
    v = random_view(spark, n=2500, seed=11)
    span = 5400
    args = (4, span, "REJECT", "SUCCESS", ("WITHDRAW", "PAYMENT"))
    exact = _chain_hits(with_lags(v, _chain_lag_spec(4)), *args)
    for hot in (9, 100):
        assert ids(_chain_hits(chain_lags(v, 4, hot_rows=hot), *args)) == ids(exact)


def test_exact_lags_with_hot_key_split_equal_plain_window(spark):
    v = random_view(spark, n=1200, seed=5)
    lags = {"p1": ("amt", 1), "p2": ("amt", 2), "p3": ("amt", 3), "r3": ("oper_result", 3),
            "d1": ("trans_date", 1)}
    cols = ["trans_id", *lags]
    want = sorted(tuple(r) for r in with_lags(v, lags).select(*cols).collect())
    for hot in (5, 40, 10**9):
        got = with_exact_lags(v, lags, hot_rows=hot)
        assert got.count() == v.count()
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == want


def test_bursts_one_second_and_equal_rows_stay_exact(spark, monkeypatch):
    import cardwatch.operators.windows as wmod
    t0 = dt.datetime(2024, 1, 1, 12)
    rows = []
    for i in range(900):      # 300 rows in a burst, 300 in one second, 300 without a time
        when = (t0 + dt.timedelta(seconds=i % 60) if i < 300 else t0 if i < 600 else None)
        for account in ("HOT", "WARM")[:1 + (i % 3 == 0)]:
            rows.append(dict(trans_id=f"{i // 4:05d}", trans_date=when, account=account,
                             passport_num="P", amt=i % 13 if i % 5 else 1,
                             oper_result="SUCCESS", terminal_city="AB"[i % 2]))
    v = view_rows(spark, rows)
    lags = {"p1": ("amt", 1), "p3": ("amt", 3), "d2": ("trans_date", 2)}
    cols = ["trans_id", "account", "amt", "terminal_city", *lags]

    def listed(df):
        return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))

    want = listed(with_lags(v, lags))
    assert listed(with_exact_lags(v, lags, hot_rows=50)) == want
    assert listed(with_exact_lags(v, lags, hot_rows=1)) == want      # 1,200 runs, copied on
    monkeypatch.setattr(wmod, "BROADCAST_KEYS", 0)
    assert listed(with_exact_lags(v, lags, hot_rows=310)) == want


def test_numbers_follow_the_order_over_all_tasks(spark):
    from cardwatch.operators.windows import numbered
    df = spark.createDataFrame([(k * 7919 % 1000 // 2,) for k in range(1000)], "x int")
    got = numbered(df.repartition(7), ["x"], "numbered", 5).collect()
    assert sorted(r["_number"] for r in got) == list(range(1000))
    assert [r["x"] for r in sorted(got, key=lambda r: r["_number"])] == sorted(
        r["x"] for r in got)


def test_hot_keys_take_one_window_over_runs(spark):
    v = random_view(spark, n=800, seed=3).cache()
    split = with_exact_lags(v, {"p": ("amt", 1)}, hot_rows=100)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [lag") == 2          # other accounts, and runs of the hot ones
    whole = with_exact_lags(v, {"p": ("amt", 1)}, hot_rows=10**6)
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("Window [lag") == 1
    v.unpersist()
