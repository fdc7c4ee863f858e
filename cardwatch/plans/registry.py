"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
built by the library operators over the generated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import day_of, file_date, file_tag, full_name, prev_second, shift_days
from ..operators import (append_new, dim_current, first_load, fraud_report, lag_chain,
                         load_transactions, report_view, rule_account, rule_brute_force,
                         rule_cities, rule_hit_counts, rule_passport, scd2_diff, scd2_merge,
                         seed_to_hist)
from ..sources import fixtures as fx
from .oracle import FIXTURE_SPAN

TERMINAL_KEY = "terminal_id"
TERMINAL_ATTRS = ("terminal_type", "terminal_city")
MERGE_AS_OF = "2024-01-15 00:00:00"
CURRENT_AS_OF = "2024-01-20 00:00:00"


def _view(spark: SparkSession, sf_dir: str, *, day=None) -> DataFrame:
    s = fx.events_star(spark, sf_dir)
    return report_view(s.facts, s.cards, s.accounts, s.clients, s.terminals, day=day,
                       fio_parts=s.fio_parts)


def _hist1(spark, sf_dir):
    return first_load(fx.terminals_day1(spark, sf_dir), TERMINAL_KEY, TERMINAL_ATTRS)


def _diff(spark, sf_dir):
    hist1 = _hist1(spark, sf_dir)
    return scd2_diff(dim_current(hist1, MERGE_AS_OF), fx.terminals_day2(spark, sf_dir),
                     TERMINAL_KEY, TERMINAL_ATTRS)


def _hist2(spark, sf_dir):
    return scd2_merge(_hist1(spark, sf_dir), fx.terminals_day2(spark, sf_dir), TERMINAL_KEY,
                      TERMINAL_ATTRS, as_of=MERGE_AS_OF)


# --- view ------------------------------------------------------------------------
def q_report_view(spark, sf_dir):
    return _view(spark, sf_dir)


def q_latest_day(spark, sf_dir):
    return _view(spark, sf_dir, day="latest")


def q_report_view_chain(spark, sf_dir):
    s = fx.lineitem_star(spark, sf_dir)
    return report_view(s.facts, s.cards, s.accounts, s.clients, s.terminals, day=None,
                       fio_parts=s.fio_parts)


def _history_view(spark, sf_dir, history):
    s = fx.events_star(spark, sf_dir, terminals=_hist2(spark, sf_dir))
    return report_view(s.facts, s.cards, s.accounts, s.clients, s.terminals, day=None,
                       history=history, fio_parts=s.fio_parts)


def q_report_view_history(spark, sf_dir):
    return _history_view(spark, sf_dir, "all")


def q_report_view_as_of(spark, sf_dir):
    return _history_view(spark, sf_dir, "as_of")


# --- rules -------------------------------------------------------------------------
def q_rule_account(spark, sf_dir):
    return rule_account(_view(spark, sf_dir))


def q_rule_passport(spark, sf_dir):
    return rule_passport(_view(spark, sf_dir), fx.blacklist(spark, sf_dir))


def q_rule_cities(spark, sf_dir):
    # The look-back reads the view twice (hot-key count, window): written once.
    return rule_cities(config.materialize(_view(spark, sf_dir), "report_view"))


def q_rule_brute_force(spark, sf_dir):
    return rule_brute_force(config.materialize(_view(spark, sf_dir), "report_view"),
                            max_span_seconds=FIXTURE_SPAN)


def q_lag_chain(spark, sf_dir):
    return lag_chain(config.materialize(_view(spark, sf_dir), "report_view"))


def q_fraud_report(spark, sf_dir):
    """The view is read by four rules: written once, then read back."""
    return fraud_report(config.materialize(_view(spark, sf_dir), "report_view"),
                        fx.blacklist(spark, sf_dir), max_span_seconds=FIXTURE_SPAN)


def q_rule_hit_counts(spark, sf_dir):
    return rule_hit_counts(q_fraud_report(spark, sf_dir))


# --- dimensions ----------------------------------------------------------------------
def q_dim_current(spark, sf_dir):
    return dim_current(_hist2(spark, sf_dir), CURRENT_AS_OF).select(TERMINAL_KEY,
                                                                    *TERMINAL_ATTRS)


def _delta(kind):
    def q(spark, sf_dir):
        return (_diff(spark, sf_dir).filter(F.col("change_type") == kind)
                .select(TERMINAL_KEY, *TERMINAL_ATTRS))
    q.__name__ = f"q_scd2_{kind}"
    return q


def q_scd2_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


def q_scd2_merge(spark, sf_dir):
    return _hist2(spark, sf_dir)


def q_dim_seed(spark, sf_dir):
    return seed_to_hist(fx.customer_clients_seed(spark, sf_dir))


# --- facts -------------------------------------------------------------------------
def q_blacklist_new(spark, sf_dir):
    return append_new(fx.blacklist_fact(spark, sf_dir), fx.blacklist_batch(spark, sf_dir))


def q_fact_append(spark, sf_dir):
    """Two overlapping loads appended to a fresh fact table and read back: the
    rows of the shared day are stored twice (no de-duplication)."""
    from .daily import read_facts, write_facts
    stg = fx.event_staging(spark, sf_dir)
    path = config.scratch_path(spark, "fact_append")
    day = F.to_date("transaction_date")
    write_facts(load_transactions(stg.filter(day <= F.lit("2024-01-15").cast("date"))),
                path, "2024-01-15")
    write_facts(load_transactions(stg.filter(day >= F.lit("2024-01-15").cast("date"))),
                path, "2024-01-31")
    return read_facts(spark, path).select(
        "trans_id", "trans_date", "card_num", "opertype", "amt", "oper_result", "terminal",
        "trans_dt", "load_dt")


# --- scalars -------------------------------------------------------------------------
def q_scalar_dates(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    name = F.concat(F.lit("transactions_"), file_tag("ts"), F.lit(".txt"))
    return e.select("event_id", day_of("ts").alias("trans_dt"),
                    shift_days("ts", 1).alias("next_day"),
                    prev_second("ts").alias("prev_second"),
                    name.alias("file_name"), file_date(name).alias("file_dt"))


def q_scalar_strings(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey",
                    F.regexp_extract("c_name", r"#([0-9]+)", 1).alias("cust_no"),
                    F.substring("c_name", 10, 4).alias("name_part"),
                    full_name("c_name", segment).alias("fio"),
                    F.concat_ws(" ", F.col("c_name"), segment).alias("fio_skip_null"))


SQL_KEYS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "report_view": q_report_view,
    "latest_day": q_latest_day,
    "report_view_chain": q_report_view_chain,
    "report_view_history": q_report_view_history,
    "report_view_as_of": q_report_view_as_of,
    "rule_account": q_rule_account,
    "rule_passport": q_rule_passport,
    "rule_cities": q_rule_cities,
    "rule_brute_force": q_rule_brute_force,
    "lag_chain": q_lag_chain,
    "fraud_report": q_fraud_report,
    "rule_hit_counts": q_rule_hit_counts,
    "dim_current": q_dim_current,
    "scd2_new": _delta("new"),
    "scd2_changed": _delta("changed"),
    "scd2_deleted": _delta("deleted"),
    "scd2_diff": q_scd2_diff,
    "scd2_merge": q_scd2_merge,
    "dim_seed": q_dim_seed,
    "blacklist_new": q_blacklist_new,
    "fact_append": q_fact_append,
    "scalar_dates": q_scalar_dates,
    "scalar_strings": q_scalar_strings,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import files_keys
    out = dict(SQL_KEYS)
    out.update(files_keys.FILE_KEYS)
    return out


def oracle_sql() -> dict[str, str]:
    from .oracle import statements
    return statements()
