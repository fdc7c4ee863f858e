"""Runs at the same time: who may commit, lost runs, and commits whose run died."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from test_daily import DAYS, build_landing, seeds

from cardwatch import config
from cardwatch.plans import claims
from cardwatch.plans import daily as pipeline


def held(spark, root, numbers=lambda: 1, store=None, **kw):
    options = {"claim_seconds": 60, "wait_seconds": 0, "poll_seconds": 0.05} | kw
    return claims.acquire(spark, root, numbers, store, **options)


def test_of_many_one_creates_the_file(spark):
    path = config.scratch_path(spark, "claims") + "/deep/1"
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda k: config.create_new(spark, path, str(k)), range(16)))
    assert sum(won) == 1
    assert config.first_line(spark, path) == str(won.index(True))


def test_a_claim_is_exclusive_until_released(spark):
    root = config.scratch_path(spark, "claims")
    first = held(spark, root)
    with pytest.raises(TimeoutError):
        held(spark, root)
    assert first.renew() and first.release()
    second = held(spark, root)
    assert second.slot == first.slot + 1
    assert not first.renew() and not first.release()
    with pytest.raises(claims.Overtaken):
        first.commit([])


def test_a_lost_run_is_overtaken_and_cannot_commit(spark):
    root = config.scratch_path(spark, "claims")
    lost = held(spark, root)
    time.sleep(1.2)
    taker = held(spark, root, claim_seconds=1, wait_seconds=10)
    with pytest.raises(claims.Overtaken):
        lost.commit([["1"]])
    taker.commit([["2"]])
    assert claims.last_slot(spark, f"{root}/commit=1")[1]["rows"] == [["2"]]


def test_a_commit_comes_before_its_takeover(spark):
    root, stored = config.scratch_path(spark, "claims"), []
    done = held(spark, root)
    done.commit([["1"]])                       # and dies before the ledger has the row
    after = held(spark, root, lambda: 1 + len(stored), stored.extend, claim_seconds=0)
    assert stored == [["1"]]
    assert claims.last_slot(spark, f"{root}/commit=2")[0] == after.slot == 0


def test_a_long_run_keeps_its_claim(spark):
    root = config.scratch_path(spark, "claims")
    with claims.claimed(spark, root, lambda: 1, None, claim_seconds=1.5) as claim:
        time.sleep(3)
        with pytest.raises(TimeoutError):
            held(spark, root, claim_seconds=1.5)
        assert claim.slot > 2
    assert held(spark, root).slot > 3          # released at the end


def test_half_written_slot_counts_as_a_claim(spark):
    root = config.scratch_path(spark, "claims")
    config.create_new(spark, f"{root}/commit=1/0", '{"kind": "com')
    with pytest.raises(TimeoutError):
        held(spark, root)
    time.sleep(0.3)
    assert held(spark, root, claim_seconds=0.1).slot == 1


@pytest.fixture(scope="module")
def landed(spark):
    root = config.scratch_path(spark, "landing")
    build_landing(root)
    return root


def new_warehouse(spark, **kw):
    wh = pipeline.Warehouse(config.scratch_path(spark, "warehouse"), **kw)
    pipeline.bootstrap(spark, wh, *seeds(spark))
    return wh


def state(spark, wh):
    top = max(r["terminals_version"] for r in pipeline.commits(spark, wh))
    tables = {p: spark.read.parquet(p).drop("report_dt") for p in
              (wh.transactions, wh.blacklist, wh.report)}
    tables["terminals"] = pipeline.terminals_hist(spark, wh, top)
    return [sorted(map(str, t.collect())) for t in tables.values()]


def at_once(*runs):
    start = threading.Barrier(len(runs))

    def go(run):
        start.wait()
        return run()

    with ThreadPoolExecutor(len(runs)) as pool:
        return [f.result() for f in [pool.submit(go, r) for r in runs]]


def test_runs_at_once_take_turns(spark, landed):
    alone = new_warehouse(spark)
    pipeline.backfill(spark, alone, landed)
    wh = new_warehouse(spark)
    # the same date twice, then twice all that is pending
    at_once(*[lambda: pipeline.run_day(spark, wh, landed, DAYS[0])] * 2)
    done = at_once(*[lambda: pipeline.backfill(spark, wh, landed, days_at_once=1)] * 2)
    assert sorted(r["date"] for run in done for r in run) == list(DAYS[1:])
    rows = pipeline.commits(spark, wh)
    assert [r["commit_no"] for r in rows] == [1, 2, 3, 4]
    assert [r["business_date"] for r in rows] == [DAYS[0], *DAYS]
    assert len({r["terminals_version"] for r in rows}) == 4
    assert state(spark, wh) == state(spark, alone)
    log = [r["event_type"] for r in spark.read.parquet(wh.meta_log).collect()]
    assert log.count("--BEGIN--") == log.count("--FINISH--") == 2


def test_a_failed_run_frees_its_commit(spark, landed, monkeypatch):
    wh = new_warehouse(spark, wait_seconds=0)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "report_view", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_day(spark, wh, landed, DAYS[0])
    assert pipeline.run_day(spark, wh, landed, DAYS[0])["terminals_version"] == 1


def test_a_commit_outlives_its_run(spark, landed, monkeypatch):
    wh = new_warehouse(spark, wait_seconds=0)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "_store_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_day(spark, wh, landed, DAYS[0])
    assert pipeline.commits(spark, wh) == []
    # the next run finds the committed date and goes on from its version
    out = pipeline.run_day(spark, wh, landed, DAYS[1])
    rows = {r["business_date"]: r for r in pipeline.commits(spark, wh)}
    assert set(rows) == set(DAYS[:2]) and rows[DAYS[0]]["loaded"] > 0
    assert rows[DAYS[0]]["first_dt"] is not None
    assert out["terminals_version"] == 2 and rows[DAYS[1]]["parent_version"] == 1
