"""Scalar expressions and landing-date discovery."""

from __future__ import annotations

import datetime as dt

from cardwatch import config
from cardwatch.functions import (amount, elapsed, file_date, full_name, prev_second, seconds,
                                 shift_days)
from cardwatch.sources import landing


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_amount_accepts_decimal_comma_and_nulls_junk(spark):
    got = one(spark, amount("a"), [("12,50",), ("7.1",), (" 3 ",), ("x1",), (None,)], "a string")
    assert [None if g is None else str(g) for g in got] == ["12.50", "7.10", "3.00", None, None]


def test_prev_second_and_next_day(spark):
    data = [(dt.datetime(2024, 1, 15, 0, 0, 0),), (None,)]
    assert one(spark, prev_second("t"), data, "t timestamp_ntz") == [
        dt.datetime(2024, 1, 14, 23, 59, 59), None]
    assert one(spark, shift_days("t", 1), data, "t timestamp_ntz") == [dt.date(2024, 1, 16), None]


def test_interval_gap_is_strict_and_sub_second(spark):
    data = [(dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 11, 0, 0)),
            (dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 1, 11, 0, 0))]
    got = one(spark, elapsed("b", "a") < seconds(3600), data, "a timestamp_ntz, b timestamp_ntz")
    assert got == [False, True]


def test_full_name_propagates_null(spark):
    got = one(spark, full_name("a", "b", "c"), [("x", "y", "z"), ("x", None, "z")],
              "a string, b string, c string")
    assert got == ["x y z", None]


def test_file_date_from_names_and_spark_folders(spark):
    paths = [("file:/l/transactions_01022021.txt",),
             ("s3a://b/l/_file=transactions_31012021.txt/part-00000-abc.c000.csv",),
             ("file:/l/readme.txt",), ("file:/l/transactions_99999999.txt",)]
    assert one(spark, file_date("p"), paths, "p string") == [
        dt.date(2021, 2, 1), dt.date(2021, 1, 31), None, None]


def test_landing_dates_sort_by_calendar_not_by_name(spark):
    root = config.scratch_path(spark, "dates-landing")
    df = spark.createDataFrame(
        [("1", dt.datetime(2021, 1, 31, 10), "1,00", "C", "PAYMENT", "SUCCESS", "T",
          dt.date(2021, 1, 31)),
         ("2", dt.datetime(2021, 2, 1, 10), "1,00", "C", "PAYMENT", "SUCCESS", "T",
          dt.date(2021, 2, 1))],
        "transaction_id string, transaction_date timestamp_ntz, amount string, card_num string,"
        " oper_type string, oper_result string, terminal string, d date")
    landing.write_landing(df, root, landing.TRANSACTIONS, "d", fmt="text")
    assert landing.landing_dates(spark, root).isEmpty()     # the other files are not there yet
    for kind in (landing.TERMINALS, landing.BLACKLIST):
        landing.write_landing(df.select("transaction_id", "d"), root, kind, "d")
    got = [r["file_date"] for r in landing.landing_dates(spark, root).orderBy("file_date")
           .collect()]
    assert got == [dt.date(2021, 1, 31), dt.date(2021, 2, 1)]   # "01022021" < "31012021"
    back = landing.read_transactions(spark, root, dt.date(2021, 2, 1))
    assert [(r["transaction_id"], str(r["amount"])) for r in back.collect()] == [("2", "1.00")]
