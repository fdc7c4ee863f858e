"""The daily batch: bootstrap, run_days, backfill, with a ledger and an audit log.

Warehouse layout (Parquet, all under one root):
  dim_cards_hist/ dim_accounts_hist/ dim_clients_hist/   written once by bootstrap
  dim_terminals_hist/delta/version=N/                     what one date changed, see scd2_log
  dim_terminals_hist/base/version=N/open, closed/         every few versions: the open rows,
                                                          and those closed since the last base
  fact_transactions/load_dt=.../trans_dt=.../             appended per business date
  fact_passport_blacklist/load_dt=.../
  rep_fraud/load_dt=.../
  rejects/load_dt=.../                                    landing rows that do not parse
  meta_log/                                               audit rows (append)
  ledger/                                                 one row per finished date (append)
  claims/commit=N/                                        who may make commit N, see claims

:func:`run_days` does any number of dates in one pass: the snapshots of all dates are folded
into one log, and facts, view and rules are keyed by report day. The number of Spark jobs does
not depend on the number of dates, and every date's rows are those that one run a date writes.

Failure model: what a business date D writes goes to folders of its own (``load_dt=D``,
emptied first), or to a terminal version that no ledger row names; the run's dates enter the
ledger last, in one file. A run that dies anywhere is simply re-run. A base is written after
that and only counts when it is complete; until then the deltas serve.

A date is pending when all three of its files are there. A late date (earlier than one
already committed) is merged on top of the current terminal state, adds only passports that
no other date has stored, and scores its own day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import (append_new, fraud_report, report_view, seed_to_hist, series_log,
                         state_of)
from ..operators.facts import TRANSACTION_RENAMES, rename
from ..operators.scd2_log import is_open
from ..schemas import (CHAIN_LENGTH, DIM_ACCOUNTS, DIM_CARDS, DIM_CLIENTS, DIM_TERMINALS,
                       FACT_BLACKLIST_STORED, FACT_TRANSACTIONS,
                       FACT_TRANSACTIONS_STORED, GRACE_DAYS, LEDGER,
                       MAX_CHAIN_SPAN_SECONDS, MAX_CITY_GAP_SECONDS, REP_FRAUD,
                       REP_FRAUD_STORED, TERMINAL_LOG, TERMINAL_STATE)
from ..sources import landing
from .claims import claimed

TERMINAL_KEY = "terminal_id"
TERMINAL_ATTRS = ("terminal_type", "terminal_city", "terminal_address")


@dataclass(frozen=True)
class Warehouse:
    root: str
    #: A new base of the terminal history after so many versions.
    compact_every: int = 32
    #: A run's claim on a commit is lost when it was not renewed for so long; so long a run
    #: waits for another.
    claim_seconds: float = 300
    wait_seconds: float = 6 * 3600

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def cards(self): return self.path("dim_cards_hist")
    @property
    def accounts(self): return self.path("dim_accounts_hist")
    @property
    def clients(self): return self.path("dim_clients_hist")
    @property
    def terminals(self): return self.path("dim_terminals_hist")
    @property
    def transactions(self): return self.path("fact_transactions")
    @property
    def blacklist(self): return self.path("fact_passport_blacklist")
    @property
    def report(self): return self.path("rep_fraud")
    @property
    def rejects(self): return self.path("rejects")
    @property
    def meta_log(self): return self.path("meta_log")
    @property
    def ledger(self): return self.path("ledger")
    @property
    def claims(self): return self.path("claims")


# --- table io ------------------------------------------------------------------------
def _append_days(df: DataFrame, path: str, *cols: str) -> None:
    """Append rows to the folders of their dates (``load_dt``, then ``cols``)."""
    df.write.mode("append").partitionBy("load_dt", *cols).parquet(path)


def _typed_facts(facts: DataFrame, *more: str) -> DataFrame:
    return facts.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                          for f in FACT_TRANSACTIONS.fields],
                        F.col("trans_dt").cast("date"), *more)


def write_facts(facts: DataFrame, path: str, load_dt) -> None:
    """Write one load of the fact table, in ``trans_dt`` partitions below its ``load_dt``.
    A retry replaces that load only; earlier loads (even of the same transactions) stay."""
    w = _typed_facts(facts).write.mode("overwrite").option("partitionOverwriteMode", "static")
    w.partitionBy("trans_dt").parquet(f"{path}/load_dt={load_dt}")


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_TRANSACTIONS_STORED).parquet(path)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    if not config.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def audit(spark: SparkSession, wh: Warehouse, rows: list[tuple[str, str]]) -> None:
    """Append audit rows (event time = current local timestamp)."""
    if not rows:
        return
    df = spark.createDataFrame(rows, "event_type string, event_desription string")
    config.append_file(df.select(F.localtimestamp().alias("event_dt"), "event_type",
                                 "event_desription"), wh.meta_log)


def commits(spark: SparkSession, wh: Warehouse) -> list:
    """All rows of the ledger in the order of their commits, one for each date and run. (A
    commit that a waiting run stored too, see claims, stands there twice.)"""
    rows = {(r["commit_no"], r["business_date"]): r
            for r in _read(spark, wh.ledger, LEDGER).collect()}
    return [rows[k] for k in sorted(rows)]


def ledger(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The last commit of each business date."""
    rows = _read(spark, wh.ledger, LEDGER)
    last = F.max_by(F.struct(*rows.columns), "commit_no").alias("r")
    return rows.groupBy("business_date").agg(last).select("r.*")


def _next_commit(spark: SparkSession, wh: Warehouse) -> int:
    return 1 + max((r["commit_no"] for r in commits(spark, wh)), default=0)


def _store_commit(spark: SparkSession, wh: Warehouse, rows: list) -> None:
    """Store a commit's rows, which its claim keeps as text, in the ledger."""
    text = ", ".join(f"{f.name} string" for f in LEDGER.fields)
    config.append_file(spark.createDataFrame(rows, text).select(
        *[F.col(f.name).cast(f.dataType) for f in LEDGER.fields]), wh.ledger)


def _current(rows) -> list:
    return list({r["business_date"]: r for r in rows}.values())


def terminal_state(rows, day: dt.date) -> tuple[int, int]:
    """(version to merge into, number of the next version), from the ledger's rows.

    That is the last committed version, except when the date that made it runs again: then
    its own parent. A late date sees the state of the latest one."""
    if not rows:
        return 0, 1
    top = min(_current(rows), key=lambda r: (-r["terminals_version"], r["business_date"]))
    again = top["business_date"] == day
    return (top["parent_version"] if again else top["terminals_version"],
            max(r["terminals_version"] for r in rows) + 1)


def _chain(rows, version: int) -> set[int]:
    """A version and all that it was made from."""
    parent = {r["terminals_version"]: r["parent_version"] for r in rows
              if r["terminals_version"] != r["parent_version"]}
    chain = {version}
    while version in parent:
        version = parent[version]
        chain.add(version)
    return chain


def _numbers(spark, path: str, complete: str | None = None) -> list[int]:
    found = [int(n[8:]) for n in config.names(spark, path) if n.startswith("version=")]
    return [n for n in found if complete is None
            or config.exists(spark, f"{path}/version={n}/{complete}/_SUCCESS")]


def _bases(spark, wh: Warehouse, chain: set[int]) -> list[int]:
    """Versions of the chain with a complete base, ascending."""
    return sorted(chain.intersection(_numbers(spark, f"{wh.terminals}/base", "open")))


def _terminal_parts(spark: SparkSession, wh: Warehouse, chain: set[int]):
    """(open rows of the last base, log since then, versions whose closed rows are stored)."""
    bases = _bases(spark, wh, chain)
    root = f"{wh.terminals}/base"
    base = spark.read.schema(TERMINAL_STATE).parquet(f"{root}/version={bases[-1]}/open")
    since = sorted(v for v in chain.intersection(_numbers(spark, f"{wh.terminals}/delta"))
                   if v > bases[-1])
    delta = f"{wh.terminals}/delta"
    log = (spark.read.schema(TERMINAL_LOG).option("basePath", delta)
           .parquet(*[f"{delta}/version={v}" for v in since])
           if since else spark.createDataFrame([], TERMINAL_LOG))
    return base, log, [f"{root}/version={v}/closed" for v in bases if v]


def _terminals(spark: SparkSession, wh: Warehouse, chain: set[int]) -> DataFrame:
    base, log, closed = _terminal_parts(spark, wh, chain)
    state = state_of(base, log, TERMINAL_KEY, TERMINAL_ATTRS).select(*TERMINAL_STATE.fieldNames())
    return state.unionByName(spark.read.schema(TERMINAL_STATE).parquet(*closed)) if closed else state


def terminals_hist(spark: SparkSession, wh: Warehouse, version: int) -> DataFrame:
    """The whole terminal history as of a version."""
    chain = _chain(commits(spark, wh), version)
    return _terminals(spark, wh, chain).select(*DIM_TERMINALS.fieldNames())


def compact(spark: SparkSession, wh: Warehouse, version: int | None = None) -> bool:
    """Write the base of a version (default: the last committed one): its open rows, and
    apart from them those closed since the last base, which are never written again. False
    where it is there. A base that a lost run left incomplete is written anew."""
    rows = commits(spark, wh)
    version = terminal_state(rows, None)[0] if version is None else version
    chain = _chain(rows, version)
    if version in _bases(spark, wh, chain):
        return False
    base, log, _ = _terminal_parts(spark, wh, chain)
    state = state_of(base, log, TERMINAL_KEY, TERMINAL_ATTRS).select(*TERMINAL_STATE.fieldNames())
    path = f"{wh.terminals}/base/version={version}"
    state.filter(~is_open()).write.mode("overwrite").parquet(f"{path}/closed")
    state.filter(is_open()).write.mode("overwrite").parquet(f"{path}/open")
    return True


# --- bootstrap -----------------------------------------------------------------------
def bootstrap(spark: SparkSession, wh: Warehouse, cards: DataFrame, accounts: DataFrame,
              clients: DataFrame) -> bool:
    """Load the seed tables as first dimension versions and an empty terminal
    history (version 0). Skipped when the warehouse already exists."""
    empty = f"{wh.terminals}/base/version=0/open"
    if config.exists(spark, f"{empty}/_SUCCESS"):
        return False
    for seed, path, schema in ((cards, wh.cards, DIM_CARDS),
                               (accounts, wh.accounts, DIM_ACCOUNTS),
                               (clients, wh.clients, DIM_CLIENTS)):
        hist = seed_to_hist(seed)
        hist.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) \
            .write.mode("overwrite").parquet(path)
    spark.createDataFrame([], TERMINAL_STATE).write.mode("overwrite").parquet(empty)
    audit(spark, wh, [("CREATE_DB", "Warehouse folders created")])
    return True


# --- one business date -----------------------------------------------------------------
@dataclass
class RuleParams:
    grace_days: int = GRACE_DAYS
    max_gap_seconds: int = MAX_CITY_GAP_SECONDS
    chain: int = CHAIN_LENGTH
    max_span_seconds: int = MAX_CHAIN_SPAN_SECONDS
    lookback_days: int = 0     # > 0: chains may start on earlier days (not the source's)


def _folders(spark: SparkSession, path: str, schema, days) -> DataFrame:
    """Rows of some dates, of whose folders alone the files are listed."""
    there = set(config.names(spark, path))
    paths = [f"{path}/load_dt={d}" for d in days if f"load_dt={d}" in there]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def _log_terminals(spark, wh, rows, days, staged, filled, close_tombstones):
    """Store what the days' snapshots change, one version each; (version, parent) by day, and
    the last one's chain. An empty snapshot would close every terminal (source bug): its day
    keeps the version."""
    version, number = terminal_state(rows, days[0])
    chain = _chain(rows, version)
    versions = {d: number + k for k, d in enumerate(d for d in days if d in filled)}
    if versions:
        base, log, _ = _terminal_parts(spark, wh, chain)
        live = state_of(base, log, TERMINAL_KEY, TERMINAL_ATTRS).filter(
            is_open() & (F.col("deleted_flg") == 0))
        for v in set(versions.values()).intersection(_numbers(spark, f"{wh.terminals}/delta")):
            config.remove(spark, f"{wh.terminals}/delta/version={v}")
        (series_log(live, staged, list(versions), list(versions.values()), TERMINAL_KEY,
                    TERMINAL_ATTRS, close_tombstones=close_tombstones)
         .select(*TERMINAL_LOG.fieldNames()).write.mode("append").partitionBy("version")
         .parquet(f"{wh.terminals}/delta"))
    out = {}
    for d in days:
        out[d] = (versions.get(d, version), version)
        version = out[d][0]
    return out, chain.union(versions.values())


def _new_passports(spark, wh, staged: DataFrame, days) -> DataFrame:
    """Rows of the days' blacklists whose passport no other date has stored before: none of
    the stored ones, and none of the earlier days of this run. NULL passports all count."""
    known = _read(spark, wh.blacklist, FACT_BLACKLIST_STORED)
    fresh = append_new(known.filter(~F.col("load_dt").isin(list(days))), staged,
                       renames=(("passport", "passport_num"), ("date", "entry_dt"),
                                ("file_date", "load_dt")))
    if len(days) == 1:
        return fresh
    first = (fresh.filter("passport_num IS NOT NULL").groupBy(F.col("passport_num").alias("_p"))
             .agg(F.min("load_dt").alias("_first")))
    return (fresh.join(first, F.col("passport_num") == F.col("_p"), "left")
            .filter(F.col("_p").isNull() | (F.col("load_dt") == F.col("_first")))
            .drop("_p", "_first"))


def _facts_of(spark, wh, zones: dict, versions: dict, lookback: int) -> DataFrame:
    """Facts of each day's report, with ``report_day``, ``view_day`` and ``_version``.

    The view of a date D is of the latest day in the loads up to D. The ledger knows first and
    last day of each load, so only the folders of loads and days that a report needs are
    opened, however many there are."""
    wanted, pairs = set(), []
    for d, (version, _) in versions.items():
        loads = {load: z for load, z in zones.items() if load <= d and z[1]}
        if not loads:
            continue
        top = max(z[1] for z in loads.values())
        span = [top - dt.timedelta(days=k) for k in range(lookback + 1)]
        pairs += [(d, top, x, version) for x in span]
        wanted |= {(load, x) for load, z in loads.items() for x in span if z[0] <= x <= z[1]}
    there = {load: set(config.names(spark, f"{wh.transactions}/load_dt={load}"))
             for load in {w[0] for w in wanted}}
    paths = [f"{wh.transactions}/load_dt={load}/trans_dt={x}" for load, x in sorted(wanted)
             if f"trans_dt={x}" in there[load]]
    facts = (spark.read.schema(FACT_TRANSACTIONS_STORED).option("basePath", wh.transactions)
             .parquet(*paths) if paths else spark.createDataFrame([], FACT_TRANSACTIONS_STORED))
    of = spark.createDataFrame(pairs, "report_day date, view_day date, _day date, _version int")
    # A row a report and day of its view, from the driver's own list.
    return facts.join(F.broadcast(of), (F.col("trans_dt") == F.col("_day"))
                      & (F.col("load_dt") <= F.col("report_day"))).drop("_day")


def run_days(spark: SparkSession, wh: Warehouse, files: dict, days: Sequence[dt.date],
             params: RuleParams | None = None, close_tombstones: bool = False,
             only_new: bool = False) -> list[dict]:
    """Land, merge, append and report business dates, ascending, in one pass; those not later
    than the committed ones go before, one by one. ``files`` has the paths by date and kind.
    ``only_new``: without dates that another run has committed by now."""
    params = params or RuleParams()
    for d in days:
        if missing := sorted(set(landing.KINDS) - set(files.get(d, ()))):
            raise FileNotFoundError(f"{landing.tag(d)}: no {', '.join(missing)} file")
    left, results = list(days), []
    while left:
        with config.scratch_scope(spark), claimed(
                spark, wh.claims, partial(_next_commit, spark, wh),
                partial(_store_commit, spark, wh), claim_seconds=wh.claim_seconds,
                wait_seconds=wh.wait_seconds) as claim:
            rows = commits(spark, wh)
            stored = {r["business_date"] for r in rows}
            if only_new:
                left = [d for d in left if d not in stored]
            now = left[:1] if stored and left and left[0] <= max(stored) else left
            if now:
                results += _run_days(spark, wh, files, now, params, close_tombstones, rows, claim)
            left = left[len(now):]
    return results


def _run_days(spark, wh, files, days, params, close_tombstones, rows, claim) -> list[dict]:
    txn, term, bl = ([p for d in days for p in files[d][k]] for k in landing.KINDS)
    for path in (wh.transactions, wh.rejects, wh.blacklist, wh.report):
        for left in {f"load_dt={d}" for d in days}.intersection(config.names(spark, path)):
            config.remove(spark, f"{path}/{left}")

    # 1. the snapshots' sizes by date
    terminals = landing.read_terminals(spark, "", paths=term)
    passports = landing.stamped_blacklist(spark, "", bl)
    staged = {(r["kind"], r["file_date"]): r["n"] for r in
              terminals.select(F.lit("terminals").alias("kind"), "file_date")
              .unionAll(passports.select(F.lit("passports"), "file_date"))
              .groupBy("kind", "file_date").agg(F.count(F.lit(1)).alias("n")).collect()}

    # 2. terminals: the dates' changes, one version each
    filled = {d for d in days if staged.get(("terminals", d))}
    versions, chain = _log_terminals(spark, wh, rows, days, terminals, filled, close_tombstones)

    # 3. blacklist: only passports that no other date has stored
    _append_days(_new_passports(spark, wh, passports, days), wh.blacklist)

    # 4. transactions: typed append, no de-duplication; rows without a time belong to no
    #    day and are only kept apart
    staging = landing.read_transactions(spark, "", paths=txn)
    loads = rename(staging.filter("transaction_date IS NOT NULL"),
                   [*TRANSACTION_RENAMES, ("file_date", "load_dt")])
    loads = loads.withColumn("trans_dt", F.to_date("trans_date"))
    _append_days(_typed_facts(loads, "load_dt"), wh.transactions, "trans_dt")
    _append_days(landing.rejected_transactions(spark, "", paths=txn)
                 .withColumnRenamed("file_date", "load_dt"), wh.rejects)
    stored = [_folders(spark, p, schema, days).select(F.lit(k).alias("kind"), "load_dt",
                                                      (F.col("trans_dt") if k == "facts" else
                                                       F.lit(None).cast("date")).alias("t"))
              for k, p, schema in (("facts", wh.transactions, FACT_TRANSACTIONS_STORED),
                                   ("passports", wh.blacklist, FACT_BLACKLIST_STORED),
                                   ("rejects", wh.rejects, "load_dt date"))]
    sizes = {(r["kind"], r["load_dt"]): r for r in reduce(DataFrame.unionAll, stored)
             .groupBy("kind", "load_dt").agg(F.count(F.lit(1)).alias("n"),
                                             F.min("t").alias("lo"), F.max("t").alias("hi"))
             .collect()}

    def size(kind, d):
        return sizes[kind, d]["n"] if (kind, d) in sizes else 0

    # 5. report views of the latest business day as of each date, materialised once in the
    #    shared scratch folder (cuts lineage; four rules read it), then the rules.
    zones = {r["business_date"]: (r["first_dt"], r["last_dt"]) for r in _current(rows)}
    zones |= {d: (z["lo"], z["hi"]) if (z := sizes.get(("facts", d))) else (None, None)
              for d in days}
    by = ("report_day", "view_day")
    view = config.materialize(report_view(
        _facts_of(spark, wh, zones, versions, params.lookback_days),
        spark.read.schema(DIM_CARDS).parquet(wh.cards),
        spark.read.schema(DIM_ACCOUNTS).parquet(wh.accounts),
        spark.read.schema(DIM_CLIENTS).parquet(wh.clients),
        _terminals(spark, wh, chain), day=None, by=by, known=("version", "_version")),
        "report_view")
    report = fraud_report(view, _read(spark, wh.blacklist, FACT_BLACKLIST_STORED),
                          grace_days=params.grace_days, max_gap_seconds=params.max_gap_seconds,
                          chain=params.chain, max_span_seconds=params.max_span_seconds,
                          since=F.col("view_day") if params.lookback_days else None,
                          by=by, known=("load_dt", "report_day"))
    _append_days(report.select(*[F.col(c) for c in REP_FRAUD.fieldNames() if c != "report_dt"],
                               F.localtimestamp().alias("report_dt"),
                               F.col("report_day").alias("load_dt")), wh.report)

    # 6. audit counts per date and rule, then the ledger: one file for all dates of the run
    hits = {}
    for r in (_folders(spark, wh.report, REP_FRAUD_STORED, days).groupBy("load_dt", "event_type")
              .agg(F.count(F.lit(1)).alias("n")).collect()):
        hits.setdefault(r["load_dt"], {})[r["event_type"]] = r["n"]
    log, done, results = [], [], []
    commit = max((r["commit_no"] for r in rows), default=0) + 1
    now = dt.datetime.now()
    for d in days:
        version, parent = versions[d]
        mine = hits.get(d, {})
        log += [("EXTRACT", f"Reading the files of {landing.tag(d)}")]
        if d not in filled:
            log += [("SKIP_TERMINALS", "The terminal snapshot is empty and was not applied")]
        log += [("EXTRACT", f"Staged passports: {staged.get(('passports', d), 0)}"),
                ("EXTRACT", f"Staged terminals: {staged.get(('terminals', d), 0)}"),
                ("EXTRACT", f"Staged transactions: {size('facts', d)}"),
                ("EXTRACT", f"Rows that do not parse: {size('rejects', d)}"),
                ("TRANSFORM", f"Stored, with {size('passports', d)} new passports")]
        log += [(f"!! {e} FRAUD !!", f"{e}: {n} report rows") for e, n in sorted(mine.items())]
        done.append((version, parent, now, d, commit, *zones[d], size("facts", d)))
        results.append({"date": d, "terminals_version": version, "hits": mine,
                        "transactions": size("facts", d), "passports": size("passports", d),
                        "rejects": size("rejects", d)})
    done = [tuple(None if v is None else str(v) for v in r) for r in done]
    claim.commit(done)
    _store_commit(spark, wh, done)
    audit(spark, wh, log)

    # 7. a new base of the terminal history, every few versions
    if sum(v > max(_bases(spark, wh, chain)) for v in chain) >= wh.compact_every:
        compact(spark, wh)
    return results


def _paths(files: DataFrame) -> dict:
    """Paths by date and kind: three rows a date."""
    out: dict = {}
    for r in files.orderBy("file_date", "kind", "path").collect():
        out.setdefault(r["file_date"], {}).setdefault(r["kind"], []).append(r["path"])
    return out


def run_day(spark: SparkSession, wh: Warehouse, landing_root: str, day: dt.date,
            params: RuleParams | None = None, close_tombstones: bool = False) -> dict:
    """Land, merge, append and report one business date."""
    files = landing.landing_files(spark, landing_root).filter(F.col("file_date") == F.lit(day))
    return run_days(spark, wh, _paths(files), [day], params, close_tombstones)[0]


def pending_dates(spark: SparkSession, wh: Warehouse, landing_root: str) -> DataFrame:
    """Business dates with all their landing files that are not yet in the ledger."""
    done = ledger(spark, wh).select(F.col("business_date").alias("file_date"))
    return (landing.landing_dates(spark, landing_root)
                   .join(done, "file_date", "left_anti").orderBy("file_date"))


def waiting_dates(spark: SparkSession, wh: Warehouse, landing_root: str) -> DataFrame:
    """Business dates outside the ledger of which some file is not there yet."""
    done = ledger(spark, wh).select(F.col("business_date").alias("file_date"))
    return (landing.landing_kinds(spark, landing_root)
                   .filter(F.size("kinds") < len(landing.KINDS))
                   .join(done, "file_date", "left_anti").orderBy("file_date"))


def backfill(spark: SparkSession, wh: Warehouse, landing_root: str,
             params: RuleParams | None = None, max_days: int | None = None,
             days_at_once: int | None = None, close_tombstones: bool = False) -> list[dict]:
    """Process the pending dates, earliest first: late ones one by one, then all others in one
    pass (or ``days_at_once`` a pass). The landing folder is listed once a run; only dates
    and their files' paths come to the driver."""
    audit(spark, wh, [("--BEGIN--", "Run started")])
    stored = ledger(spark, wh).select(F.col("business_date").alias("file_date"))
    files = _paths(landing.landing_files(spark, landing_root)
                   .join(stored, "file_date", "left_anti"))
    days = [d for d in sorted(files) if len(files[d]) == len(landing.KINDS)][:max_days]
    newest = stored.agg(F.max("file_date")).first()[0] if days else None
    runs = [[d] for d in days if newest and d < newest]
    rest = days[len(runs):]
    step = days_at_once or max(1, len(rest))
    runs += [rest[k:k + step] for k in range(0, len(rest), step)]
    results = [r for run in runs
               for r in run_days(spark, wh, files, run, params, close_tombstones, only_new=True)]
    if not results:
        audit(spark, wh, [("NO_FILES", "No date is pending")])
    audit(spark, wh, [("--FINISH--", f"Run ended after {len(results)} dates")])
    return results
