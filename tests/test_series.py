"""A series of snapshots folded at once against one merge after the other; many dates in one
pass against one run a date; bases, lost runs and what a date reads and writes."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from test_daily import DAYS, TERMS, build_landing, put, seeds

from cardwatch import config
from cardwatch.operators import scd2_merge, series_log, state_of
from cardwatch.operators.scd2_log import is_open
from cardwatch.plans import daily as pipeline
from cardwatch.schemas import DIM_TERMINALS, TERMINAL_STATE
from cardwatch.sources import landing

KEY, ATTRS = "terminal_id", ("terminal_type", "terminal_city", "terminal_address")
DATES = [dt.date(2021, 3, d) for d in (1, 2, 4, 5, 9, 10)]


def snapshots(odd: bool) -> dict:
    """Rows by date of about 25 keys that come, change, go and come back; ``odd`` adds
    repeated rows, NULL keys and NULL attributes."""
    r = random.Random(7 + odd)
    out = {}
    for d in DATES:
        rows = []
        for k in range(25):
            if r.random() < 0.3:
                continue
            row = (f"T{k}", r.choice("ab"), r.choice(["Omsk", "Perm"]), "x")
            rows.append(row)
            if odd and k < 6:
                extra = r.random()
                if extra < 0.3:
                    rows.append(row)
                elif extra < 0.5:
                    rows.append((f"T{k}", "c", None, "x"))
                elif extra < 0.7:
                    rows.append((None, r.choice("ab"), "Tver", None))
        out[d] = rows
    return out


def listed(df):
    return sorted((tuple(map(str, r)) for r in df.select(*DIM_TERMINALS.fieldNames()).collect()))


@pytest.mark.parametrize("odd,close", [(False, False), (False, True), (True, False),
                                       (True, True)])
def test_series_equals_one_merge_after_the_other(spark, odd, close):
    snaps = snapshots(odd)
    schema = "terminal_id string, terminal_type string, terminal_city string, " \
             "terminal_address string, file_date date"
    rows = [(*row, d) for d, found in snaps.items() for row in found]
    stored = spark.createDataFrame(rows, schema)
    hist = spark.createDataFrame([], DIM_TERMINALS)
    half = None
    for k, d in enumerate(DATES):
        hist = config.materialize(scd2_merge(
            hist, stored.filter(F.col("file_date") == F.lit(d)), KEY, ATTRS, snapshot_date=d,
            as_of=d, close_tombstones=close).select(*DIM_TERMINALS.fieldNames()), "merged")
        if k == 2:
            half = hist
    none = spark.createDataFrame([], TERMINAL_STATE)

    def fold(base, dates, first):
        live = base.filter(is_open() & (F.col("deleted_flg") == 0))
        log = series_log(live, stored, dates, list(range(first, first + len(dates))), KEY, ATTRS,
                         close_tombstones=close)
        return state_of(base, log, KEY, ATTRS).select(*TERMINAL_STATE.fieldNames())

    assert listed(fold(none, DATES, 1)) == listed(hist)
    # Half of the dates, then the others on what they left.
    first = config.materialize(fold(none, DATES[:3], 1), "first")
    assert listed(first) == listed(half)
    closed = first.filter(~is_open())
    second = fold(first.filter(is_open()), DATES[3:], 4)
    assert listed(second.unionByName(closed)) == listed(hist)


def test_unchanged_rows_leave_nothing_in_the_log(spark):
    rows = [(f"T{k}", "a", "Omsk", "x", d) for k in range(50) for d in DATES[:4]]
    snap = spark.createDataFrame(rows, "terminal_id string, terminal_type string, "
                                 "terminal_city string, terminal_address string, file_date date")
    none = spark.createDataFrame([], TERMINAL_STATE)
    log = series_log(none, snap, DATES[:4], [1, 2, 3, 4], KEY, ATTRS)
    assert log.count() == 50 and log.select("version").distinct().collect() == [(1,)]


# --- the daily run ---------------------------------------------------------------------------
def rich_landing(root):
    """Six dates: terminals that move, go and come back, a snapshot without rows, transactions
    of other days, a blacklist that repeats, no new transactions on one date."""
    head = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
    city = [["T1;POS;Omsk;a", "T2;ATM;Kazan;b"], ["T1;POS;Omsk;a"], [],
            ["T1;POS;Perm;a", "T2;ATM;Kazan;b"], ["T1;POS;Perm;a", "T2;ATM;Tver;b", "T3;P;O;c"],
            ["T2;ATM;Tver;b", ";POS;Omsk;n"]]
    for k, d in enumerate(DATES):
        rows = []
        for n in range(0 if k == 4 else 8):
            when = dt.datetime.combine(d, dt.time(10, 5 * n)) - dt.timedelta(days=k == 3 and n < 2)
            rows.append(f"{k}-{n};{when};{900 - n},00;C{n % 3 + 1};WITHDRAW;"
                        f"{'SUCCESS' if n % 4 == 3 else 'REJECT'};T{n % 2 + 1}\n")
        rows.append(f"{k}-x;soon;1,00;C1;WITHDRAW;SUCCESS;T1\n")
        listed_ = "".join(f"{d};{p}\n" for p in (["9999 000003", ""] if k % 2 else ["9999 000022"]))
        put(root, d, head + "".join(rows), TERMS + "".join(r + "\n" for r in city[k]),
            "date;passport\n" + listed_)


def contents(spark, wh, dates):
    out = {}
    for name, path in (("facts", wh.transactions), ("passports", wh.blacklist),
                       ("rejects", wh.rejects), ("report", wh.report)):
        df = spark.read.parquet(path)
        df = df.select(*sorted(c for c in df.columns if c != "report_dt"))
        out[name] = sorted(tuple(map(str, r)) for r in df.collect())
    last = {r["business_date"]: r for r in pipeline.ledger(spark, wh).collect()}
    out["ledger"] = [tuple(map(str, (d, last[d]["terminals_version"], last[d]["parent_version"],
                                     last[d]["first_dt"], last[d]["last_dt"], last[d]["loaded"])))
                     for d in dates]
    for d in dates:
        hist = pipeline.terminals_hist(spark, wh, last[d]["terminals_version"])
        out[f"terminals {d}"] = listed(hist)
    log = spark.read.parquet(wh.meta_log).filter("event_type NOT LIKE '--%'")
    out["audit"] = sorted((r["event_type"], r["event_desription"]) for r in log.collect())
    return out


@pytest.fixture(scope="module")
def both(spark):
    """The same dates in one pass, and one run a date with a base every second version."""
    root = config.scratch_path(spark, "series-landing")
    rich_landing(root)
    got = []
    for at_once, every in ((None, 32), (1, 2)):
        wh = pipeline.Warehouse(config.scratch_path(spark, "series-warehouse"), every)
        pipeline.bootstrap(spark, wh, *seeds(spark))
        params = pipeline.RuleParams(lookback_days=1)
        results = pipeline.backfill(spark, wh, root, params, days_at_once=at_once)
        got.append((wh, results))
    return root, got


def test_one_pass_equals_one_run_a_date(spark, both):
    _, ((one, at_once), (many, each)) = both
    assert at_once == each and len(each) == len(DATES)
    a, b = contents(spark, one, DATES), contents(spark, many, DATES)
    assert a == b
    assert a["report"] and len(a["passports"]) == 5   # two passports once, the NULL one each time


def test_closed_rows_are_written_once(spark, both):
    _, (_, (wh, _)) = both
    bases = pipeline._numbers(spark, f"{wh.terminals}/base", "open")
    assert len(bases) == 3 and 0 in bases
    closed = [r for v in bases if v for r in
              spark.read.parquet(f"{wh.terminals}/base/version={v}/closed").collect()]
    assert closed and len(closed) == len(set(closed))


def test_a_base_lost_half_way_does_not_count(spark, both):
    _, ((wh, _), _) = both
    last = max(r["terminals_version"] for r in pipeline.commits(spark, wh))
    want = listed(pipeline.terminals_hist(spark, wh, last))
    assert pipeline.compact(spark, wh) and not pipeline.compact(spark, wh)
    assert listed(pipeline.terminals_hist(spark, wh, last)) == want
    done = config.local_path(f"{wh.terminals}/base/version={last}/open/_SUCCESS")
    os.remove(done)                                    # the run died before the commit
    assert pipeline._bases(spark, wh, pipeline._chain(pipeline.commits(spark, wh), last)) == [0]
    assert listed(pipeline.terminals_hist(spark, wh, last)) == want
    assert pipeline.compact(spark, wh)
    assert listed(pipeline.terminals_hist(spark, wh, last)) == want


def test_a_rerun_of_the_last_date_starts_from_its_parent(spark, both):
    root, (_, (wh, _)) = both
    before = contents(spark, wh, DATES)
    pipeline.run_day(spark, wh, root, DATES[-1], pipeline.RuleParams(lookback_days=1))
    after = contents(spark, wh, DATES)
    for name in ("facts", "passports", "rejects", "report", f"terminals {DATES[-1]}"):
        assert after[name] == before[name]


def test_only_the_days_of_a_report_are_opened(spark, both):
    _, ((wh, _), _) = both
    rows = pipeline._current(pipeline.commits(spark, wh))
    zones = {r["business_date"]: (r["first_dt"], r["last_dt"]) for r in rows}
    facts = pipeline._facts_of(spark, wh, zones, {DATES[-1]: (6, 5)}, 0)
    opened = {f.split("/load_dt=")[1].split("/part")[0] for f in facts.inputFiles()}
    assert opened == {f"{DATES[-1]}/trans_dt={DATES[-1]}"}
    # The load of 5 March has rows of 4 March, too: both loads are opened for that day.
    facts = pipeline._facts_of(spark, wh, zones, {DATES[3]: (3, 2)}, 1)
    opened = {f.split("/load_dt=")[1].split("/part")[0] for f in facts.inputFiles()}
    assert opened == {f"{DATES[3]}/trans_dt={DATES[3]}", f"{DATES[3]}/trans_dt={DATES[2]}",
                      f"{DATES[2]}/trans_dt={DATES[2]}"}


def test_number_of_jobs_does_not_depend_on_the_dates(spark):
    root = config.scratch_path(spark, "jobs-landing")
    build_landing(root)
    sc, jobs = spark.sparkContext, []
    for n in (1, 3):
        wh = pipeline.Warehouse(config.scratch_path(spark, "jobs-warehouse"))
        pipeline.bootstrap(spark, wh, *seeds(spark))
        sc.setJobGroup(f"dates-{n}", "")
        pipeline.backfill(spark, wh, root, max_days=n)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"dates-{n}")))
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 6
    assert len(DAYS) == 3


def test_scratch_of_a_run_is_removed(spark):
    root = config.scratch_path(spark, "scratch-landing")
    put(root, DAYS[0])
    wh = pipeline.Warehouse(config.scratch_path(spark, "scratch-warehouse"))
    pipeline.bootstrap(spark, wh, *seeds(spark))
    top = f"{config.shared_root(spark)}/cardwatch"
    before = {n: config.names(spark, f"{top}/{n}") for n in ("report_view", "rule_hits",
                                                             "scd2_events")}
    pipeline.backfill(spark, wh, root)
    assert before == {n: config.names(spark, f"{top}/{n}") for n in before}


def test_kind_and_date_come_from_the_file_name(spark, tmp_path):
    root = str(tmp_path / "transactions_landing_01012021.d" / "terminals_in")
    put(root, DAYS[0])
    kinds = landing.landing_kinds(spark, root).collect()
    assert [(r["file_date"], r["kinds"]) for r in kinds] == [(DAYS[0], sorted(landing.KINDS))]


def test_files_of_one_run_may_have_different_headers(spark):
    root = config.scratch_path(spark, "headers-landing")
    put(root, DAYS[0])
    put(root, DAYS[1], "amount;card_num;transaction_id;oper_type;terminal;oper_result;"
        "transaction_date;more\n5,00;C2;1;PAYMENT;T1;SUCCESS;2021-02-01 10:00:00;z\n")
    wh = pipeline.Warehouse(config.scratch_path(spark, "headers-warehouse"))
    pipeline.bootstrap(spark, wh, *seeds(spark))
    assert [r["transactions"] for r in pipeline.backfill(spark, wh, root)] == [1, 1]
    assert {str(r["amt"]) for r in pipeline.read_facts(spark, wh.transactions).collect()} == {"5.00"}
