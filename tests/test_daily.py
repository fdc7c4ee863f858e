"""End to end: three business dates of landing files written by the test,
bootstrap, backfill earliest first, ledger, audit, idempotent re-run."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from cardwatch import config
from cardwatch.plans import daily as pipeline
from cardwatch.sources import landing

DAYS = (dt.date(2021, 1, 31), dt.date(2021, 2, 1), dt.date(2021, 2, 2))


def write(path: str, text: str) -> None:
    path = config.local_path(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def txn_file(rows):
    head = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
    return head + "".join(";".join(r) + "\n" for r in rows)


def build_landing(root):
    t1, t2, t3 = (landing.tag(d) for d in DAYS)
    # day 1: card 1 withdraws after its account expired (2021-01-29 -> hit from 01-30)
    write(f"{root}/transactions_{t1}.txt", txn_file([
        ("1", "2021-01-31 10:00:00", "100,50", "C1", "WITHDRAW", "SUCCESS", "T1"),
        ("2", "2021-01-31 10:20:00", "20,00", "C2", "PAYMENT", "SUCCESS", "T1"),
        ("3", "2021-01-31 10:40:00", "junk", "C2", "PAYMENT", "SUCCESS", "T1"),
    ]))
    # day 2: card 2 in two cities 30 min apart; card 3 blacklisted passport
    write(f"{root}/transactions_{t2}.txt", txn_file([
        ("4", "2021-02-01 09:00:00", "5,00", "C2", "PAYMENT", "SUCCESS", "T1"),
        ("5", "2021-02-01 09:30:00", "6,00", "C2", "PAYMENT", "REJECT", "T2"),
        ("6", "2021-02-01 12:00:00", "7,00", "C3", "PAYMENT", "SUCCESS", "T1"),
    ]))
    # day 3: card 2 guesses the amount: R R R S with falling amounts in 10 minutes
    write(f"{root}/transactions_{t3}.txt", txn_file([
        ("7", "2021-02-02 08:00:00", "900,00", "C2", "WITHDRAW", "REJECT", "T1"),
        ("8", "2021-02-02 08:02:00", "800,00", "C2", "WITHDRAW", "REJECT", "T1"),
        ("9", "2021-02-02 08:04:00", "700,00", "C2", "WITHDRAW", "REJECT", "T1"),
        ("10", "2021-02-02 08:06:00", "600,00", "C2", "WITHDRAW", "SUCCESS", "T1"),
    ]))
    term_head = "terminal_id;terminal_type;terminal_city;terminal_address\n"
    write(f"{root}/terminals_{t1}.csv", term_head + "T1;POS;Moscow;a1\nT2;ATM;Kazan;a2\n")
    write(f"{root}/terminals_{t2}.csv", term_head + "T1;POS;Moscow;a1\nT2;ATM;Kazan;a2\n")
    # day 3: T2 moved, T3 new
    write(f"{root}/terminals_{t3}.csv", term_head + "T1;POS;Moscow;a1\nT2;ATM;Omsk;a9\n"
          "T3;POS;Tver;a3\n")
    bl_head = "date;passport\n"
    write(f"{root}/passport_blacklist_{t1}.csv", bl_head + "2021-01-31;9999 000001\n")
    write(f"{root}/passport_blacklist_{t2}.csv",
          bl_head + "2021-01-31;9999 000001\n2021-02-01;9999 000003\n")
    write(f"{root}/passport_blacklist_{t3}.csv",
          bl_head + "2021-01-31;9999 000001\n2021-02-01;9999 000003\n")


def seeds(spark):
    cards = spark.createDataFrame(
        [("C1", "AC1", dt.date(1900, 1, 1), None), ("C2", "AC2", dt.date(1900, 1, 1), None),
         ("C3", "AC3", dt.date(1900, 1, 1), None)],
        "card_num string, account string, create_dt date, update_dt date")
    accounts = spark.createDataFrame(
        [("AC1", dt.date(2021, 1, 29), "11", dt.date(1900, 1, 1), None),
         ("AC2", dt.date(2030, 1, 1), "VIP-22", dt.date(1900, 1, 1), None),
         ("AC3", dt.date(2030, 1, 1), "33", dt.date(1900, 1, 1), None)],
        "account string, valid_to date, client string, create_dt date, update_dt date")
    clients = spark.createDataFrame(
        [("11", "Ivanov", "Ivan", "Ivanovich", None, "9999 000011", None, "+7 1",
          dt.date(1900, 1, 1), None),
         ("VIP-22", "Petrov", "Petr", "Petrovich", None, "9999 000022", dt.date(2040, 1, 1),
          "+7 2", dt.date(1900, 1, 1), None),
         ("33", "Sidorov", "Sidor", "Sidorovich", None, "9999 000003", None, "+7 3",
          dt.date(1900, 1, 1), None)],
        "client_id string, last_name string, first_name string, patronymic string, "
        "date_of_birth date, passport_num string, passport_valid_to date, phone string, "
        "create_dt date, update_dt date")
    return cards, accounts, clients


@pytest.fixture(scope="module")
def warehouse(spark):
    root = config.scratch_path(spark, "test-landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "test-warehouse"))
    build_landing(root)
    assert pipeline.bootstrap(spark, wh, *seeds(spark))
    assert not pipeline.bootstrap(spark, wh, *seeds(spark))     # idempotent
    results = pipeline.backfill(spark, wh, root)
    return spark, wh, root, results


def test_landing_reader_types_and_comma_amounts(spark, warehouse):
    _, _, root, _ = warehouse
    stg = landing.read_transactions(spark, root, DAYS[0])
    amounts = {r["transaction_id"]: r["amount"] for r in stg.collect()}
    assert str(amounts["1"]) == "100.50" and amounts["3"] is None
    assert {r["file_date"] for r in stg.collect()} == {DAYS[0]}
    assert [r["file_date"] for r in
            landing.read_terminals(spark, root, DAYS[2]).collect()] == [DAYS[2]] * 3


def test_backfill_runs_dates_in_calendar_order(warehouse):
    spark, wh, _, results = warehouse
    assert [r["date"] for r in results] == list(DAYS)
    led = [(r["business_date"], r["terminals_version"])
           for r in pipeline.ledger(spark, wh).orderBy("business_date").collect()]
    assert led == [(DAYS[0], 1), (DAYS[1], 2), (DAYS[2], 3)]
    assert pipeline.pending_dates(spark, wh, warehouse[2]).count() == 0


def test_report_hits_per_day(warehouse):
    spark, wh, _, results = warehouse
    got = sorted((r["load_dt"], r["event_type"], r["passport"])
                 for r in spark.read.parquet(wh.report).collect())
    assert got == sorted([
        (DAYS[0], "ACCOUNT", "9999 000011"),
        (DAYS[1], "CITIES", "9999 000022"),
        (DAYS[1], "PASSPORT", "9999 000003"),
        (DAYS[2], "BRUTE_FORCE", "9999 000022"),
    ])


def test_terminal_history_versions(warehouse):
    spark, wh, _, _ = warehouse
    hist = pipeline.terminals_hist(spark, wh, 3)
    rows = sorted((r["terminal_id"], r["terminal_city"], r["deleted_flg"],
                   str(r["effective_to"])) for r in hist.collect())
    assert rows == [("T1", "Moscow", 0, "9999-12-31 23:59:59"),
                    ("T2", "Kazan", 0, "2021-02-01 23:59:59"),
                    ("T2", "Omsk", 0, "9999-12-31 23:59:59"),
                    ("T3", "Tver", 0, "9999-12-31 23:59:59")]


def test_blacklist_only_new_passports(warehouse):
    spark, wh, _, results = warehouse
    assert [r["passports"] for r in results] == [1, 1, 0]
    assert spark.read.parquet(wh.blacklist).count() == 2


def test_audit_and_rerun_is_idempotent(warehouse):
    spark, wh, root, _ = warehouse
    log = spark.read.parquet(wh.meta_log)
    assert log.filter("event_type = 'CREATE_DB'").count() == 1
    assert log.filter("event_desription like 'Staged transactions: %'").count() == 3
    loaded = sorted(r["event_desription"] for r in log.filter("event_type = 'EXTRACT'")
                    .filter("event_desription like 'Staged %'").collect())
    assert "Staged passports: 2" in loaded and "Staged terminals: 3" in loaded
    assert log.filter("event_type = '--FINISH--'").count() == 1
    before_facts = spark.read.parquet(wh.transactions).count()
    before_report = spark.read.parquet(wh.report).count()
    # a crash after the writes but before the ledger: the day is simply re-run
    pipeline.run_day(spark, wh, root, DAYS[2])
    assert spark.read.parquet(wh.transactions).count() == before_facts
    assert spark.read.parquet(wh.report).count() == before_report
    led = pipeline.ledger(spark, wh)
    # the committed folder of version 3 stays; the new attempt has a version of its own
    top = led.orderBy(led.terminals_version.desc()).first()
    assert led.count() == 3 and (top["terminals_version"], top["parent_version"]) == (4, 2)
    assert pipeline.terminals_hist(spark, wh, 3).count() == 4
    assert pipeline.terminals_hist(spark, wh, 4).count() == 4
    assert pipeline.backfill(spark, wh, root) == []


def test_lookback_days_reports_each_day_once(spark):
    root = config.scratch_path(spark, "lookback-landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "lookback-warehouse"))
    build_landing(root)
    pipeline.bootstrap(spark, wh, *seeds(spark))
    pipeline.backfill(spark, wh, root, pipeline.RuleParams(lookback_days=1))
    got = sorted((r["load_dt"], r["event_type"], r["passport"])
                 for r in spark.read.parquet(wh.report).collect())
    # the previous day is look-back context only: its hits are not reported again
    assert got == sorted([
        (DAYS[0], "ACCOUNT", "9999 000011"),
        (DAYS[1], "CITIES", "9999 000022"),
        (DAYS[1], "PASSPORT", "9999 000003"),
        (DAYS[2], "BRUTE_FORCE", "9999 000022"),
    ])


# --- days that are not as they should be ---------------------------------------------------
HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
QUIET = HEAD + "1;2021-01-31 10:00:00.250;5,00;C2;PAYMENT;SUCCESS;T1\n"
TERMS = "terminal_id;terminal_type;terminal_city;terminal_address\n"


def put(root, day, txn=QUIET, terms=TERMS + "T1;POS;Moscow;a1\n", blacklist="date;passport\n"):
    t = landing.tag(day)
    for kind, ext, text in (("transactions", "txt", txn), ("terminals", "csv", terms),
                            ("passport_blacklist", "csv", blacklist)):
        if text is not None:
            write(f"{root}/{kind}_{t}.{ext}", text)


@pytest.fixture
def fresh(spark):
    root = config.scratch_path(spark, "odd-landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "odd-warehouse"))
    pipeline.bootstrap(spark, wh, *seeds(spark))
    return spark, wh, root


def test_first_day_without_hits_and_with_an_empty_blacklist(fresh):
    spark, wh, root = fresh
    put(root, DAYS[0])
    (r,) = pipeline.backfill(spark, wh, root)
    assert r["hits"] == {} and r["passports"] == 0 and r["transactions"] == 1
    assert str(pipeline.read_facts(spark, wh.transactions).first()["trans_date"]) \
        == "2021-01-31 10:00:00.250000"
    assert pipeline.pending_dates(spark, wh, root).isEmpty()


def test_a_rerun_replaces_more_output_by_less(fresh):
    spark, wh, root = fresh
    put(root, DAYS[0], HEAD + "1;2021-01-31 10:00:00;5,00;C1;PAYMENT;SUCCESS;T1\n"
        "2;2021-01-30 10:00:00;5,00;C2;PAYMENT;SUCCESS;T1\n",
        blacklist="date;passport\n2021-01-31;9999 000001\n")
    assert pipeline.run_day(spark, wh, root, DAYS[0])["hits"] == {"ACCOUNT": 1}
    put(root, DAYS[0])
    assert pipeline.run_day(spark, wh, root, DAYS[0])["hits"] == {}
    assert pipeline._read(spark, wh.report, pipeline.REP_FRAUD_STORED).count() == 0
    assert pipeline.read_facts(spark, wh.transactions).count() == 1
    assert pipeline._read(spark, wh.blacklist, pipeline.FACT_BLACKLIST_STORED).count() == 0


def test_a_date_waits_for_all_its_files(fresh):
    spark, wh, root = fresh
    put(root, DAYS[0], terms=None)
    assert pipeline.backfill(spark, wh, root) == []
    assert [r["file_date"] for r in pipeline.waiting_dates(spark, wh, root).collect()] == [DAYS[0]]
    with pytest.raises(FileNotFoundError, match="terminals"):
        pipeline.run_day(spark, wh, root, DAYS[0])
    put(root, DAYS[0])
    assert len(pipeline.backfill(spark, wh, root)) == 1


def test_a_late_date_keeps_committed_versions(fresh):
    spark, wh, root = fresh
    days = [dt.date(2021, 2, d) for d in (1, 2, 3, 4)]
    listed = "date;passport\n2021-02-01;9999 000001\n"
    city = {0: "T1;POS;Moscow;a1\n", 1: "T1;POS;Moscow;a1\nT3;POS;Perm;a3\n",
            2: "T1;POS;Omsk;a1\nT2;POS;Tver;a2\n",
            3: "T1;POS;Omsk;a1\nT2;POS;Tver;a2\nT3;POS;Perm;a3\n"}
    for k in (0, 2, 1, 3):
        put(root, days[k], terms=TERMS + city[k], blacklist=listed)
        (r,) = pipeline.backfill(spark, wh, root)
        if k == 2:
            before = sorted(map(tuple, pipeline.terminals_hist(spark, wh, 2).collect()), key=str)
    led = {r["business_date"]: r["terminals_version"] for r in pipeline.ledger(spark, wh).collect()}
    assert [led[d] for d in days] == [1, 3, 2, 4]
    after = sorted(map(tuple, pipeline.terminals_hist(spark, wh, 2).collect()), key=str)
    assert after == before
    live = pipeline.terminals_hist(spark, wh, 4).filter(
        "effective_to = timestamp'9999-12-31 23:59:59' AND deleted_flg = 0").collect()
    assert {(r["terminal_id"], r["terminal_city"]) for r in live} >= {
        ("T1", "Omsk"), ("T2", "Tver"), ("T3", "Perm")}
    assert pipeline._read(spark, wh.blacklist, pipeline.FACT_BLACKLIST_STORED).count() == 1


def test_columns_are_bound_by_name_and_bad_rows_kept_apart(fresh):
    spark, wh, root = fresh
    put(root, DAYS[0], "amount;card_num;transaction_id;oper_type;terminal;oper_result;"
        "transaction_date\n5,00;C2;1;PAYMENT;T1;SUCCESS;2021-01-31 10:00:00\n"
        "x;C2;2;PAYMENT;T1;SUCCESS;2021-01-31 10:00:01\n5,00;C2;3;PAYMENT;T1;SUCCESS;soon\n")
    (r,) = pipeline.backfill(spark, wh, root)
    assert (r["transactions"], r["rejects"]) == (2, 2)
    got = {x["trans_id"]: (x["card_num"], x["amt"], x["opertype"])
           for x in pipeline.read_facts(spark, wh.transactions).collect()}
    assert str(got["1"][1]) == "5.00" and got["1"][::2] == ("C2", "PAYMENT") and got["2"][1] is None
    put(root, DAYS[1], "transaction_id;transaction_date\n1;2021-02-01 00:00:00\n")
    with pytest.raises(ValueError, match="no column"):
        landing.read_transactions(spark, root, DAYS[1])


def test_registered_run_lands_a_file_of_each_kind_for_every_day_of_events(spark, tmp_path):
    from pyspark.sql import functions as F

    from cardwatch.functions import day_of
    from cardwatch.plans import files_keys
    from cardwatch.sources import fixtures, landing
    root = str(tmp_path / "landing")
    files_keys.build_landing(spark, "/root/testdata/sf0.001", root)
    events = fixtures.table(spark, "/root/testdata/sf0.001", "events")
    want = {r[0] for r in events.select(day_of("ts")).distinct().collect()}
    assert len(want) == 30
    assert {r["file_date"] for r in landing.landing_dates(spark, root).collect()} == want
    rows = landing.read_transactions(spark, root)
    assert rows.count() == events.count()
    assert rows.filter(day_of("transaction_date") != F.col("file_date")).isEmpty()
