"""The four fraud rules over the report view, and the combined report.

Each rule is a lazy DataFrame. ``first_per_passport`` keeps the earliest hit
per passport with a ``min(struct(...))`` aggregate: partial aggregation runs
before the shuffle, so a passport with many hits (or the NULL passport of
unknown cards) is pre-reduced on the map side instead of being sent whole to
one task as a ``row_number`` window would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import elapsed, seconds, shift_days
from ..schemas import (CHAIN_LENGTH, EVENT_ACCOUNT, EVENT_BRUTE_FORCE, EVENT_CITIES,
                       EVENT_PASSPORT, GRACE_DAYS, GUESS_OPERTYPES, MAX_CHAIN_SPAN_SECONDS,
                       MAX_CITY_GAP_SECONDS, REPORT_COLUMNS, RESULT_FAIL, RESULT_OK)
from .windows import with_exact_lags


def _earliest(hits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per passport: ``_first`` = the earliest hit as a struct."""
    first = F.min(F.struct("trans_date", "trans_id", "fio", "phone")).alias("_first")
    return hits.groupBy("passport_num", *by).agg(first)


def _report_first(earliest: DataFrame, event_type: str, by: Sequence[str] = ()) -> DataFrame:
    return earliest.select(F.col("_first.trans_date").alias("event_dt"),
                           F.col("passport_num").alias("passport"),
                           F.col("_first.fio").alias("fio"),
                           F.col("_first.phone").alias("phone"),
                           F.lit(event_type).alias("event_type"), *by)


def first_per_passport(hits: DataFrame, event_type: str, by: Sequence[str] = ()) -> DataFrame:
    """Earliest hit per passport (ties broken by ``trans_id``); ``fio`` and
    ``phone`` come from that same row. NULL passports form one group. ``by``: columns
    that tell the reports of one view apart, here and in the rules."""
    return _report_first(_earliest(hits, by), event_type, by)


def expired(ts: str, valid_to: str, grace_days: int = GRACE_DAYS):
    """``ts`` is on or after the day following the expiry date.

    The source compares text (``'D+1 00:00:00' > 'D+1'`` is true), so the
    first instant of day D+1 already counts; a NULL expiry never matches."""
    return F.col(ts) >= shift_days(valid_to, grace_days)


def rule_account(view: DataFrame, *, grace_days: int = GRACE_DAYS,
                 ok: str = RESULT_OK, by: Sequence[str] = ()) -> DataFrame:
    """A successful operation after the account contract expired."""
    hits = view.filter(expired("trans_date", "valid_to", grace_days)
                       & (F.col("oper_result") == ok))
    return first_per_passport(hits, EVENT_ACCOUNT, by)


def rule_passport(view: DataFrame, blacklist: DataFrame, *, grace_days: int = GRACE_DAYS,
                  ok: str = RESULT_OK, by: Sequence[str] = (),
                  known: tuple[str, str] | None = None) -> DataFrame:
    """Operation with an expired passport (any result), or a successful one with
    a blacklisted passport. Membership ignores the blacklist entry date. ``known =
    (blacklist, view)`` names two columns: a listing counts in the reports whose column is not
    below its own (each day's report knows the passports stored by then).

    The earliest hit of the disjunction is the earlier of the two branch
    minima. One per-passport aggregation (map-side partial, so a hot passport
    is pre-reduced) yields both: the earliest lapsed-passport row and the
    earliest successful row. Only these per-passport rows meet the blacklist
    (broadcast where AQE finds them small), so neither all view rows nor a hot or
    NULL passport are shuffled for the membership test."""
    row = F.struct("trans_date", "trans_id", "fio", "phone")
    lapsed = expired("trans_date", "passport_valid_to", grace_days)
    success = (F.col("oper_result") == ok) & F.col("passport_num").isNotNull()
    per = (view.filter(lapsed | success).groupBy("passport_num", *by)
               .agg(F.min(F.when(lapsed, row)).alias("_lapsed"),
                    F.min(F.when(success, row)).alias("_success"))
               .filter(F.col("_lapsed").isNotNull() | F.col("_success").isNotNull()))
    listed = (blacklist.filter(F.col("passport_num").isNotNull())
              .groupBy(F.col("passport_num").alias("_listed"))
              .agg(F.min(known[0] if known else "passport_num").alias("_since")))
    member = F.col("passport_num") == F.col("_listed")
    if known:
        member = member & (F.col("_since") <= F.col(known[1]))
    first = F.least(F.col("_lapsed"),
                    F.when(F.col("_listed").isNotNull(), F.col("_success")))
    earliest = (per.join(listed, member, "left")
                   .select("passport_num", first.alias("_first"), *by)
                   .filter(F.col("_first").isNotNull()))
    return _report_first(earliest, EVENT_PASSPORT, by)


CITY_LAGS = {"_prev_city": ("terminal_city", 1), "_prev_date": ("trans_date", 1)}


def _chain_lag_spec(chain: int) -> dict:
    lags = {}
    for back in range(chain - 1, 0, -1):
        lags[f"_amt_{back}"] = ("amt", back)
        lags[f"_res_{back}"] = ("oper_result", back)
    lags[f"_date_{chain - 1}"] = ("trans_date", chain - 1)
    return lags


def city_lags(view: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Previous city and time per account (hot accounts split by row count)."""
    return with_exact_lags(view, CITY_LAGS, hot_rows=hot_rows)


def chain_lags(view: DataFrame, chain: int, hot_rows: int | None = None) -> DataFrame:
    return with_exact_lags(view, _chain_lag_spec(chain), hot_rows=hot_rows)


def _city_condition(max_gap_seconds: int):
    # `city <> previous city` is NULL when either is NULL: no hit (as in SQL).
    return ((F.col("terminal_city") != F.col("_prev_city"))
            & (elapsed("trans_date", "_prev_date") < seconds(max_gap_seconds)))


def _city_hits(lagged: DataFrame, max_gap_seconds: int) -> DataFrame:
    return lagged.filter(_city_condition(max_gap_seconds))


def rule_cities(view: DataFrame, *, max_gap_seconds: int = MAX_CITY_GAP_SECONDS,
                lagged: DataFrame | None = None) -> DataFrame:
    """Operation in a different city than the account's previous operation,
    less than ``max_gap_seconds`` later, whatever the result. Reported once per
    passport at the earliest such (second) operation."""
    lagged = lagged if lagged is not None else city_lags(view)
    return first_per_passport(_city_hits(lagged, max_gap_seconds), EVENT_CITIES)


def _chain_condition(chain: int, max_span_seconds: int, fail: str, ok: str,
                     opertypes: Sequence[str]):
    amounts = [F.col(f"_amt_{b}") for b in range(chain - 1, 0, -1)] + [F.col("amt")]
    results = [F.col(f"_res_{b}") for b in range(chain - 1, 0, -1)]
    cond = F.col("oper_result") == ok
    for before, after in zip(amounts, amounts[1:]):
        cond = cond & (before > after)
    for r in results:
        cond = cond & (r == fail)
    return (cond & F.col("opertype").isin(list(opertypes))
            & (elapsed("trans_date", f"_date_{chain - 1}") < seconds(max_span_seconds)))


def _chain_hits(lagged: DataFrame, chain: int, max_span_seconds: int, fail: str, ok: str,
                opertypes: Sequence[str]) -> DataFrame:
    return lagged.filter(_chain_condition(chain, max_span_seconds, fail, ok, opertypes))


def rule_brute_force(view: DataFrame, *, chain: int = CHAIN_LENGTH,
                     max_span_seconds: int = MAX_CHAIN_SPAN_SECONDS,
                     fail: str = RESULT_FAIL, ok: str = RESULT_OK,
                     opertypes: Sequence[str] = GUESS_OPERTYPES,
                     lagged: DataFrame | None = None) -> DataFrame:
    """Amount guessing: ``chain-1`` rejected operations then a successful one,
    amounts strictly falling, the last a withdrawal or payment, first to last
    less than ``max_span_seconds``. One report row per hit (not grouped)."""
    lagged = lagged if lagged is not None else chain_lags(view, chain)
    hits = _chain_hits(lagged, chain, max_span_seconds, fail, ok, opertypes)
    return hits.select(F.col("trans_date").alias("event_dt"),
                       F.col("passport_num").alias("passport"), "fio", "phone",
                       F.lit(EVENT_BRUTE_FORCE).alias("event_type"))


def lag_chain(view: DataFrame, chain: int = CHAIN_LENGTH, hot_rows: int | None = None
              ) -> DataFrame:
    """The raw look-back columns of the amount rule: exact, unbounded lags,
    with hot accounts split (see :func:`with_exact_lags`)."""
    lags = {k: v for k, v in _chain_lag_spec(chain).items() if not k.startswith("_date")}
    lagged = with_exact_lags(view, lags, hot_rows=hot_rows)
    cols = [F.col(f"_amt_{b}").alias(f"amount_back_{b}") for b in range(chain - 1, 0, -1)]
    cols.append(F.col("amt").alias("amount"))
    cols += [F.col(f"_res_{b}").alias(f"result_back_{b}") for b in range(chain - 1, 0, -1)]
    cols.append(F.col("oper_result").alias("result"))
    return lagged.select("trans_id", "account", *cols)


def fraud_report(view: DataFrame, blacklist: DataFrame, *,
                 grace_days: int = GRACE_DAYS,
                 max_gap_seconds: int = MAX_CITY_GAP_SECONDS,
                 chain: int = CHAIN_LENGTH,
                 max_span_seconds: int = MAX_CHAIN_SPAN_SECONDS,
                 fail: str = RESULT_FAIL, ok: str = RESULT_OK,
                 opertypes: Sequence[str] = GUESS_OPERTYPES,
                 since=None, by: Sequence[str] = (),
                 known: tuple[str, str] | None = None) -> DataFrame:
    """ACCOUNT, PASSPORT, CITIES and BRUTE_FORCE hits as one multiset.

    ``since`` (a date, timestamp or Column) reports only hits at or after it;
    earlier view rows then only serve as look-back context (used with a view
    built with ``lookback_days``). ``by`` and ``known``: several reports at once, see
    :func:`rule_passport`; the look-back never crosses from one to another.

    CITIES and BRUTE_FORCE read one shared lagged frame (one window, one
    shuffle), whose few tagged hits are written once."""
    lagged = with_exact_lags(view, {**CITY_LAGS, **_chain_lag_spec(chain)},
                             partition=("account", *by))
    if since is not None:
        start = (since if isinstance(since, Column) else F.lit(since)).cast("timestamp_ntz")
        in_scope = F.col("trans_date") >= start
        lagged = lagged.filter(in_scope)
        view = view.filter(in_scope)
    # Hits first, then their tags: the window runs once and only hits are doubled.
    city = F.coalesce(_city_condition(max_gap_seconds), F.lit(False))
    guess = F.coalesce(_chain_condition(chain, max_span_seconds, fail, ok, opertypes),
                       F.lit(False))
    rule = F.explode(F.filter(F.array(F.when(city, F.lit(EVENT_CITIES)),
                                      F.when(guess, F.lit(EVENT_BRUTE_FORCE))),
                              lambda x: x.isNotNull())).alias("_rule")
    tagged = config.materialize(
        lagged.filter(city | guess).select("trans_date", "trans_id", "passport_num", "fio",
                                           "phone", rule, *by), "rule_hits")
    cities = first_per_passport(tagged.filter(F.col("_rule") == EVENT_CITIES), EVENT_CITIES, by)
    guesses = tagged.filter(F.col("_rule") == EVENT_BRUTE_FORCE).select(
        F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"),
        "fio", "phone", F.col("_rule").alias("event_type"), *by)
    parts = [
        rule_account(view, grace_days=grace_days, ok=ok, by=by),
        rule_passport(view, blacklist, grace_days=grace_days, ok=ok, by=by, known=known),
        cities,
        guesses,
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_COLUMNS, *by)


def rule_hit_counts(report: DataFrame) -> DataFrame:
    """Hits per event type (the audit counts)."""
    return report.groupBy("event_type").agg(F.count(F.lit(1)).alias("hits"))
