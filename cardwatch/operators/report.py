"""The wide report view: facts joined to card, account, client and terminal
dimensions, restricted to a business day, de-duplicated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of, full_name
from ..schemas import VIEW_COLUMNS
from .joins import broadcast_if_small

HISTORY_ALL = "all"      # every dimension version joins (source-compatible fan-out)
HISTORY_AS_OF = "as_of"  # only the version valid at the transaction time


def _day_column(facts: DataFrame) -> Column:
    # Filter on the partition column when the fact table has one, so the scan
    # prunes partitions (a scalar subquery becomes a runtime partition filter).
    return F.col("trans_dt") if "trans_dt" in facts.columns else day_of("trans_date")


def restrict_day(facts: DataFrame, day: str | dt.date | None = "latest",
                 lookback_days: int = 0) -> DataFrame:
    """Keep one business day: ``"latest"`` (the maximum day present), a given
    date, or ``None`` for every day. ``[D, D+1)`` equals ``day(trans_date) = D``.
    ``lookback_days = N`` also keeps the N days before D (context for look-back
    rules whose chains cross midnight; the source looks at D only)."""
    if day is None:
        return facts
    day_col = _day_column(facts)
    if isinstance(day, str) and day == "latest":
        target = facts.select(F.max(day_col)).scalar()
    else:
        target = F.lit(day).cast("date")
    if lookback_days:
        return facts.filter(day_col.between(F.date_sub(target, int(lookback_days)), target))
    return facts.filter(day_col == target)


def _versions(dim: DataFrame, prefix: str, keep: dict[str, Column | str],
              history: str) -> DataFrame:
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in keep.items()]
    if history == HISTORY_AS_OF:
        cols += [F.col("effective_from").alias(f"{prefix}_from"),
                 F.col("effective_to").alias(f"{prefix}_to")]
        dim = dim.filter(F.col("deleted_flg") == 0)
    return dim.select(*cols)


def _on(key_left: str, key_right: str, prefix: str, history: str) -> Column:
    cond = F.col(key_left) == F.col(key_right)
    if history == HISTORY_AS_OF:
        # A version that ends at 23:59:59 holds that whole second.
        cond = (cond & (F.col("trans_date") >= F.col(f"{prefix}_from"))
                & (F.col("trans_date") < F.col(f"{prefix}_to")
                   + F.expr("INTERVAL 1 SECOND")))
    return cond


def owner_dim(cards: DataFrame, accounts: DataFrame, clients: DataFrame, *,
              fio_parts: tuple[str, ...] = ("last_name", "first_name", "patronymic")
              ) -> DataFrame:
    """Card -> account -> client attributes joined dimension-side, keyed by
    ``_k_card``. ``(F LEFT JOIN K) LEFT JOIN A`` equals ``F LEFT JOIN (K LEFT
    JOIN A)`` when the second condition only involves K and A, so the fact is
    joined (and, when this is too big to broadcast, shuffled) once, not three
    times."""
    k = _versions(cards, "_k", {"_k_card": "card_num", "_k_account": "account"}, HISTORY_ALL)
    a = _versions(accounts, "_a", {"_a_account": "account", "valid_to": "valid_to",
                                   "client": "client"}, HISTORY_ALL)
    c = _versions(clients, "_c", {"_c_client": "client_id", "passport_num": "passport_num",
                                  "passport_valid_to": "passport_valid_to",
                                  "fio": full_name(*fio_parts), "phone": "phone"}, HISTORY_ALL)
    return (k.join(a, F.col("_k_account") == F.col("_a_account"), "left")
             .join(c, F.col("client") == F.col("_c_client"), "left")
             .drop("_k_account", "_c_client"))


def _intervals(dim: DataFrame, key: str, keep: dict[str, Column | str]) -> DataFrame:
    """The live versions of each key as one array of (from, until, ...), ``until`` exclusive (a
    version that ends at 23:59:59 holds that whole second)."""
    cols = [F.col("effective_from").alias("from"),
            (F.col("effective_to") + F.expr("INTERVAL 1 SECOND")).alias("until"),
            *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in keep.items()]]
    rows = dim.filter("deleted_flg = 0").select(F.col(key).alias("_key"), F.struct(*cols).alias("v"))
    return (rows.filter("_key IS NOT NULL AND v.from < v.until").groupBy("_key")
            .agg(F.collect_list("v").alias("_versions")))


def _intersect(left: DataFrame, key: str, right: DataFrame, name: str) -> DataFrame:
    """Every row of ``left``, valid in [_from, _until), cut along the versions that its key has
    on the right: a row for each version it meets, with their common time and the version as
    ``name``, and one for each stretch without a version, where ``name`` is NULL."""
    joined = left.join(right, F.col(key) == F.col("_key"), "left")
    kind = right.schema["_versions"].dataType.elementType.simpleString()
    piece = f"STRUCT<from: timestamp_ntz, until: timestamp_ntz, v: {kind}>"
    met = f"""array_sort(transform(
        filter(coalesce(_versions, CAST(array() AS ARRAY<{kind}>)),
               v -> v.from < _until AND v.until > _from),
        v -> CAST(struct(greatest(v.from, _from), least(v.until, _until), v) AS {piece})))"""
    state = f"STRUCT<at: timestamp_ntz, gaps: ARRAY<{piece}>>"
    gaps = f"""aggregate(_met, CAST(struct(_from, array()) AS {state}),
        (acc, p) -> CAST(struct(greatest(acc.at, p.until), IF(p.from > acc.at,
            concat(acc.gaps, array(CAST(struct(acc.at, p.from, NULL) AS {piece}))), acc.gaps))
            AS {state}),
        acc -> IF(acc.at < _until,
            concat(acc.gaps, array(CAST(struct(acc.at, _until, NULL) AS {piece}))), acc.gaps))"""
    keep = [c for c in left.columns if c not in ("_from", "_until")]
    return (joined.withColumn("_met", F.expr(met))
            .select(*keep, F.explode(F.concat("_met", F.expr(gaps))).alias("_p"))
            .select(*keep, F.col("_p.from").alias("_from"), F.col("_p.until").alias("_until"),
                    F.col("_p.v").alias(name)))


def owner_as_of(cards: DataFrame, accounts: DataFrame, clients: DataFrame, *,
                fio_parts: tuple[str, ...] = ("last_name", "first_name", "patronymic")
                ) -> DataFrame:
    """Card -> account -> client attributes with the time in which they hold together, keyed by
    ``_k_card`` and valid in [_from, _until): the validities of the three are intersected
    dimension-side, so the fact is joined once. Versions that overlap give a row each, times
    without an account or client version rows with NULL attributes, as three LEFT joins by
    transaction time do."""
    k = (cards.filter("deleted_flg = 0")
         .select(F.col("card_num").alias("_k_card"), F.col("account").alias("_k_account"),
                 F.col("effective_from").alias("_from"),
                 (F.col("effective_to") + F.expr("INTERVAL 1 SECOND")).alias("_until"))
         .filter("_from < _until"))
    a = _intervals(accounts, "account", {"_a_account": "account", "valid_to": "valid_to",
                                         "client": "client"})
    c = _intervals(clients, "client_id", {
        "passport_num": "passport_num", "passport_valid_to": "passport_valid_to",
        "fio": full_name(*fio_parts), "phone": "phone"})
    with_account = _intersect(k, "_k_account", a, "_a").select(
        "_k_card", "_from", "_until", "_a._a_account", "_a.valid_to", "_a.client")
    return _intersect(with_account, "client", c, "_c").select(
        "_k_card", "_from", "_until", "_a_account", "valid_to", "client", "_c.passport_num",
        "_c.passport_valid_to", "_c.fio", "_c.phone")


def report_view(facts: DataFrame, cards: DataFrame, accounts: DataFrame,
                clients: DataFrame, terminals: DataFrame, *,
                day: str | dt.date | None = "latest", history: str = HISTORY_ALL,
                fio_parts: tuple[str, ...] = ("last_name", "first_name", "patronymic"),
                distinct: bool = True, broadcast_rows: int | None = None,
                lookback_days: int = 0, by: Sequence[str] = (),
                known: tuple[str, str] | None = None) -> DataFrame:
    """Transactions of one business day with owner and terminal attributes.

    Every join is LEFT OUTER, so a transaction with an unknown card, account,
    client or terminal stays, with NULL attributes. ``history="all"`` joins
    every version of each dimension (the source behaviour: a terminal whose
    city changed yields one row per distinct city); ``history="as_of"`` joins
    the live version at ``trans_date`` only.

    With ``by`` the view holds several reports at once, told apart by these columns of the
    facts. ``known = (terminals, facts)`` names two columns of numbers: a terminal row joins
    the facts whose number is not below its own, so that each report sees the terminal history
    as it was.

    Dimensions are broadcast where the planner or AQE finds them small in bytes, or, with
    ``broadcast_rows``, where a count shows at most so many rows; larger ones are
    shuffle-joined, and AQE splits skewed keys.
    """
    f = restrict_day(facts, day, lookback_days).select(
        "trans_id", "trans_date", "oper_result", "card_num", "amt", "opertype",
        F.col("terminal").alias("_f_terminal"), *by,
        *([F.col(known[1]).alias("_f_known")] if known else []))
    t = _versions(terminals, "_t", {"_t_id": "terminal_id", "terminal_city": "terminal_city",
                                    **({"_t_known": known[0]} if known else {})}, history)
    t = broadcast_if_small(t, broadcast_rows)
    if history == HISTORY_ALL:
        owner = owner_dim(cards, accounts, clients, fio_parts=fio_parts)
        owner = broadcast_if_small(owner, broadcast_rows)
        joined = f.join(owner, F.col("card_num") == F.col("_k_card"), "left")
    else:
        owner = broadcast_if_small(owner_as_of(cards, accounts, clients, fio_parts=fio_parts),
                                   broadcast_rows)
        joined = f.join(owner, (F.col("card_num") == F.col("_k_card"))
                        & (F.col("trans_date") >= F.col("_from"))
                        & (F.col("trans_date") < F.col("_until")), "left")
    there = _on("_f_terminal", "_t_id", "_t", history)
    if known:
        there = there & (F.col("_t_known") <= F.col("_f_known"))
    joined = joined.join(t, there, "left")
    out = joined.select(*[F.col(n) for n in VIEW_COLUMNS if n != "account"], *by,
                        F.col("_a_account").alias("account")).select(*VIEW_COLUMNS, *by)
    if not distinct:
        return out
    # Duplicates are rare (re-delivered rows, version fan-out), so a map-side
    # partial DISTINCT only costs a hash map before the shuffle. Hashing on
    # three of the DISTINCT columns satisfies the DISTINCT's clustering, so the
    # de-duplication runs after one shuffle; malformed lines, whose ids are NULL
    # or repeat, are spread by their time and card.
    # When the owner dimension is shuffle-joined this is a second shuffle, on
    # purpose: nothing downstream depends on the card_num partitioning, so AQE
    # stays free to split a skewed join partition (a hot card, or the NULL
    # card of all unmatched rows).
    return out.repartition("trans_id", "trans_date", "card_num").distinct()
