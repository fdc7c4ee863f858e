"""Registered queries that go through files: landing files are generated from
the given tables into the shared scratch folder, then read back with the
landing readers or run through the daily pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import day_of
from ..operators import load_transactions
from ..schemas import LEDGER, REP_FRAUD_STORED
from ..sources import fixtures as fx
from ..sources import landing
from . import daily as pipeline
from .oracle import FIXTURE_SPAN


def _stage_transactions(spark: SparkSession, sf_dir: str, file_day: F.Column | None = None
                        ) -> DataFrame:
    """Events as landing transaction rows (amount written with a decimal comma);
    ``file_day`` picks the landing file of each row (default: its own date)."""
    stg = fx.event_staging(spark, sf_dir)
    day = file_day if file_day is not None else day_of("transaction_date")
    return stg.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        "transaction_date",
        F.col("amount").cast("decimal(12,2)").cast("string").alias("_amt"),
        F.col("card_num").cast("string").alias("card_num"),
        "oper_type", "oper_result", F.col("terminal").cast("string").alias("terminal"),
        day.alias("_day"),
    ).select("transaction_id", "transaction_date",
             F.regexp_replace("_amt", r"\.", ",").alias("amount"),
             "card_num", "oper_type", "oper_result", "terminal", "_day")


def _terminal_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("terminal_id").cast("string").alias("terminal_id"),
                     "terminal_type", "terminal_city",
                     F.concat(F.lit("addr "), F.col("terminal_id").cast("string"))
                      .alias("terminal_address"),
                     F.col("file_date").alias("_day"))


def q_load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = config.scratch_path(spark, "landing")
    landing.write_landing(_stage_transactions(spark, sf_dir), root, landing.TRANSACTIONS,
                          "_day", fmt="text")
    return load_transactions(landing.read_transactions(spark, root).drop("file_date"))


def q_load_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = config.scratch_path(spark, "landing")
    snaps = _terminal_rows(fx.terminals_day1(spark, sf_dir)).unionByName(
        _terminal_rows(fx.terminals_day2(spark, sf_dir)))
    landing.write_landing(snaps, root, landing.TERMINALS, "_day")
    return landing.read_terminals(spark, root)


def q_load_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = config.scratch_path(spark, "landing")
    landing.write_landing(fx.blacklist_batch(spark, sf_dir).select(
        "date", "passport", F.col("date").alias("_day")), root, landing.BLACKLIST, "_day")
    return landing.read_blacklist(spark, root)


def q_pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with transaction files minus the dates already in the ledger
    (here: the dates of the first ten days of events)."""
    root = config.scratch_path(spark, "landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "warehouse"))
    landing.write_landing(_stage_transactions(spark, sf_dir), root, landing.TRANSACTIONS,
                          "_day", fmt="text")
    days = fx.table(spark, sf_dir, "events").select(day_of("ts").alias("business_date")).distinct()
    landing.write_landing(days.select(
        F.lit("T").alias("terminal_id"), F.lit("ATM").alias("terminal_type"),
        F.lit("city").alias("terminal_city"), F.lit("addr").alias("terminal_address"),
        F.col("business_date").alias("_day")), root, landing.TERMINALS, "_day")
    landing.write_landing(days.select(
        F.col("business_date").alias("date"), F.lit("P").alias("passport"),
        F.col("business_date").alias("_day")), root, landing.BLACKLIST, "_day")
    done = (days
            .filter(F.col("business_date") <= F.lit(dt.date(2024, 1, 10))))
    known = {"processed_at": F.localtimestamp(), "business_date": F.col("business_date")}
    done.select(*[known.get(f.name, F.lit(0)).cast(f.dataType).alias(f.name)
                  if f.name not in ("first_dt", "last_dt")
                  else F.col("business_date").alias(f.name) for f in LEDGER.fields]
                ).write.parquet(wh.ledger)
    return pipeline.pending_dates(spark, wh, root)


def build_landing(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The three files of every day of events, so each day reaches the rules. The second
    terminal snapshot and the full blacklist hold from ``fx.DAY2`` on."""
    landing.write_landing(_stage_transactions(spark, sf_dir), root, landing.TRANSACTIONS,
                          "_day", fmt="text")
    days = F.broadcast(fx.table(spark, sf_dir, "events").filter("ts IS NOT NULL")
                       .select(day_of("ts").alias("_day")).distinct())
    first, second = F.col("_day") < F.lit(fx.DAY2), F.col("_day") >= F.lit(fx.DAY2)

    def daily(before: DataFrame, after: DataFrame) -> DataFrame:
        return (before.drop("_day").crossJoin(days.filter(first))
                      .unionByName(after.drop("_day").crossJoin(days.filter(second))))

    landing.write_landing(daily(_terminal_rows(fx.terminals_day1(spark, sf_dir)),
                                _terminal_rows(fx.terminals_day2(spark, sf_dir))),
                          root, landing.TERMINALS, "_day")
    known = fx.blacklist_fact(spark, sf_dir).select(F.col("entry_dt").alias("date"),
                                                    F.col("passport_num").alias("passport"))
    landing.write_landing(daily(known, fx.blacklist_batch(spark, sf_dir)), root,
                          landing.BLACKLIST, "_day")


def seeds(spark: SparkSession, sf_dir: str):
    """cards / accounts / clients seed tables derived from customer, as text ids."""
    cards = fx.customer_cards(spark, sf_dir)
    accounts = fx.customer_accounts(spark, sf_dir)
    clients = fx.customer_clients_seed(spark, sf_dir)
    created = F.lit(fx.SEED_CREATED).alias("create_dt")
    nodate = F.lit(None).cast("date").alias("update_dt")
    return (cards.select(F.col("card_num").cast("string"), F.col("account").cast("string"),
                         created, nodate),
            accounts.select(F.col("account").cast("string"), "valid_to",
                            F.col("client").cast("string"), created, nodate),
            clients.select(F.col("client_id").cast("string"), "last_name", "first_name",
                           F.when(F.col("client_id") % 4 != 0,
                                  F.concat(F.lit("of "), F.col("first_name"))).alias("patronymic"),
                           F.lit(None).cast("date").alias("date_of_birth"),
                           "passport_num", "passport_valid_to", "phone", created, nodate))


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap from seeds, then every day of events, earliest first; the accumulated
    fraud report without its wall-clock ``report_dt``."""
    root = config.scratch_path(spark, "landing")
    wh = pipeline.Warehouse(config.scratch_path(spark, "warehouse"))
    build_landing(spark, sf_dir, root)
    pipeline.bootstrap(spark, wh, *seeds(spark, sf_dir))
    pipeline.backfill(spark, wh, root, pipeline.RuleParams(max_span_seconds=FIXTURE_SPAN))
    return spark.read.schema(REP_FRAUD_STORED).parquet(wh.report).drop("report_dt")


FILE_KEYS = {
    "load_transactions": q_load_transactions,
    "load_terminals": q_load_terminals,
    "load_blacklist": q_load_blacklist,
    "pending_dates": q_pending_dates,
    "daily_run": q_daily_run,
}
