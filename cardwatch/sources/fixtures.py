"""Adapters that present the generated benchmark tables in warehouse shape.

Role mapping: events -> transactions (user_id is card and account), customer ->
accounts and clients, supplier + nation -> terminals, customers with a negative
balance -> passport blacklist; lineitem -> transactions, orders -> cards for
the four-join chain. The modulo expressions below *generate* attributes
(expiry dates, a second terminal snapshot with renamed, moved and removed
terminals); every row of every table still flows through the operators.

Each builder has a DuckDB twin in :mod:`cardwatch.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_of, full_name
from ..operators.facts import seed_to_hist

# Fixed fixture values: snapshot dates of the two terminal files, the base
# dates of the generated account and passport expiries, the seed creation day.
DAY1 = dt.date(2024, 1, 1)
DAY2 = dt.date(2024, 1, 15)
ACCOUNT_EXPIRY_BASE = dt.date(2024, 1, 5)
PASSPORT_EXPIRY_BASE = dt.date(2024, 1, 8)
SEED_CREATED = dt.date(1900, 1, 1)
NATIONS = 25


# Declared schemas of the generated tables (what a catalog would hold); reading
# with them skips footer inference on the driver.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_days(base: dt.date, days) -> F.Column:
    return F.date_add(F.lit(base), days.cast("int"))


def oper_result(event_type: F.Column) -> F.Column:
    return F.when(event_type.isin("purchase", "click"), "SUCCESS").otherwise("REJECT")


def opertype(event_type: F.Column) -> F.Column:
    return (F.when(event_type.isin("purchase", "error"), "PAYMENT")
             .when(event_type.isin("click", "view"), "WITHDRAW").otherwise("DEPOSIT"))


def supplier_count(spark: SparkSession, sf_dir: str) -> F.Column:
    """``(SELECT count(*) FROM supplier)`` as a scalar-subquery column."""
    return table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def event_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staged transaction rows (landing column names)."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(F.col("event_id").alias("transaction_id"),
                    F.col("ts").alias("transaction_date"),
                    F.col("user_id").alias("card_num"),
                    opertype(et).alias("oper_type"),
                    F.col("value").alias("amount"),
                    oper_result(et).alias("oper_result"),
                    (F.col("event_id") % supplier_count(spark, sf_dir)).alias("terminal"))


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(F.col("event_id").alias("trans_id"), F.col("ts").alias("trans_date"),
                    oper_result(et).alias("oper_result"), F.col("user_id").alias("card_num"),
                    F.col("value").alias("amt"), opertype(et).alias("opertype"),
                    (F.col("event_id") % supplier_count(spark, sf_dir)).alias("terminal"),
                    day_of("ts").alias("trans_dt"))


def customer_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return seed_to_hist(c.select(F.col("c_custkey").alias("card_num"),
                                 F.col("c_custkey").alias("account"),
                                 F.lit(SEED_CREATED).alias("create_dt")))


def customer_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return seed_to_hist(c.select(
        F.col("c_custkey").alias("account"),
        _plus_days(ACCOUNT_EXPIRY_BASE, F.col("c_custkey") % 40).alias("valid_to"),
        F.col("c_custkey").alias("client"), F.lit(SEED_CREATED).alias("create_dt")))


def customer_clients_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("client_id"), F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("passport_num"),
        F.when(F.col("c_custkey") % 5 != 0,
               _plus_days(PASSPORT_EXPIRY_BASE, F.col("c_custkey") % 35))
         .alias("passport_valid_to"),
        F.concat(F.lit("+7 "), F.col("c_custkey").cast("string")).alias("phone"),
        F.lit(SEED_CREATED).alias("create_dt"))


def customer_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_to_hist(customer_clients_seed(spark, sf_dir))


CLIENT_FIO = ("last_name", "first_name")


def terminals_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .select(F.col("s_suppkey").alias("terminal_id"),
                     F.col("s_name").alias("terminal_type"),
                     F.col("n_name").alias("terminal_city"),
                     F.lit(DAY1).alias("file_date")))


def terminals_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: every fifth terminal moved to the next nation, another
    fifth re-numbered (old id gone, new id appears), every seventh removed."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    nation = F.when(key % 5 == 0, (F.col("s_nationkey") + 1) % NATIONS) \
              .otherwise(F.col("s_nationkey"))
    return (s.filter(key % 7 != 3)
             .join(n, nation == n.n_nationkey)
             .select(F.when(key % 5 == 2, key + 1000000).otherwise(key).alias("terminal_id"),
                     F.col("s_name").alias("terminal_type"),
                     F.col("n_name").alias("terminal_city"),
                     F.lit(DAY2).alias("file_date")))


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_acctbal") < 0).select(F.col("c_name").alias("passport_num"))


def blacklist_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's blacklist file: every negative-balance customer."""
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_acctbal") < 0).select(F.lit(DAY2).alias("date"),
                                                   F.col("c_name").alias("passport"))


def blacklist_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulated blacklist before today: the even-keyed listed customers."""
    c = table(spark, sf_dir, "customer")
    return c.filter((F.col("c_acctbal") < 0) & (F.col("c_custkey") % 2 == 0)).select(
        F.col("c_name").alias("passport_num"), F.lit(DAY1).alias("entry_dt"))


@dataclass
class Star:
    facts: DataFrame
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    terminals: DataFrame
    blacklist: DataFrame
    fio_parts: tuple[str, ...] = CLIENT_FIO


def events_star(spark: SparkSession, sf_dir: str, terminals: DataFrame | None = None) -> Star:
    from ..operators.scd2 import first_load
    if terminals is None:
        terminals = first_load(terminals_day1(spark, sf_dir), "terminal_id",
                               ("terminal_type", "terminal_city"))
    return Star(event_facts(spark, sf_dir), customer_cards(spark, sf_dir),
                customer_accounts(spark, sf_dir), customer_clients(spark, sf_dir),
                terminals, blacklist(spark, sf_dir))


def lineitem_star(spark: SparkSession, sf_dir: str) -> Star:
    """lineitem as transactions, orders as cards (card = order, account =
    customer), customer as accounts and clients, supplier + nation as terminals."""
    from ..operators.scd2 import first_load
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    facts = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("trans_id"),
        F.col("l_shipdate").alias("trans_date"),
        F.when(F.col("l_returnflag") == "R", "REJECT").otherwise("SUCCESS").alias("oper_result"),
        F.col("l_orderkey").alias("card_num"), F.col("l_extendedprice").alias("amt"),
        F.when(F.col("l_linestatus") == "O", "PAYMENT").otherwise("WITHDRAW").alias("opertype"),
        F.col("l_suppkey").alias("terminal"))
    cards = seed_to_hist(o.select(F.col("o_orderkey").alias("card_num"),
                                  F.col("o_custkey").alias("account"),
                                  F.lit(SEED_CREATED).alias("create_dt")))
    terminals = first_load(terminals_day1(spark, sf_dir), "terminal_id",
                           ("terminal_type", "terminal_city"))
    return Star(facts, cards, customer_accounts(spark, sf_dir),
                customer_clients(spark, sf_dir), terminals, blacklist(spark, sf_dir))


__all__ = ["DAY1", "DAY2", "Star", "events_star", "lineitem_star", "terminals_day1",
           "terminals_day2", "blacklist", "blacklist_batch", "blacklist_fact",
           "event_staging", "event_facts", "customer_clients_seed", "table", "full_name"]
