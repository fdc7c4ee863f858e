"""Micro-batch ingestion: the stream triggers backfill; dates run in calendar
order whatever the file arrival order, and a second run finds nothing new."""

from __future__ import annotations

from test_daily import DAYS, build_landing, seeds

from cardwatch import config
from cardwatch.plans import daily as pipeline
from cardwatch.streaming import start_ingest


def test_available_now_ingest(spark):
    root = config.scratch_path(spark, "stream-landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "stream-warehouse"))
    build_landing(root)
    pipeline.bootstrap(spark, wh, *seeds(spark))
    q = start_ingest(spark, wh, root)
    q.awaitTermination(600)
    assert q.exception() is None
    led = [r["business_date"] for r in pipeline.ledger(spark, wh).orderBy("business_date")
           .collect()]
    assert led == list(DAYS)
    q2 = start_ingest(spark, wh, root)
    q2.awaitTermination(600)
    assert pipeline.ledger(spark, wh).count() == 3


def test_missing_snapshot_files_are_empty(spark):
    from cardwatch.sources import landing
    root = config.scratch_path(spark, "empty-landing")
    assert landing.read_terminals(spark, root, DAYS[0]).count() == 0
    assert landing.read_blacklist(spark, root, DAYS[0]).count() == 0
