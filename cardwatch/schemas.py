"""Landing and warehouse schemas, and the fixed values the pipeline relies on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# Fixed values (must stay equal to the source system's for the same results):
# the open end of a validity interval, the operation results, the operation
# types checked by the amount-guessing rule, the four report event types, the
# rule constants (grace of one day after expiry, 3600 s between cities, a
# chain of 4 operations within 1200 s).
OPEN_END = dt.datetime(9999, 12, 31, 23, 59, 59)
RESULT_OK = "SUCCESS"
RESULT_FAIL = "REJECT"
GUESS_OPERTYPES = ("WITHDRAW", "PAYMENT")
EVENT_ACCOUNT = "ACCOUNT"
EVENT_PASSPORT = "PASSPORT"
EVENT_CITIES = "CITIES"
EVENT_BRUTE_FORCE = "BRUTE_FORCE"
GRACE_DAYS = 1
MAX_CITY_GAP_SECONDS = 3600
CHAIN_LENGTH = 4
MAX_CHAIN_SPAN_SECONDS = 1200

S = T.StringType()
D = T.DateType()
TS = T.TimestampNTZType()
I = T.IntegerType()
AMT = T.DecimalType(12, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def extend(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """A copy of ``schema`` with more nullable fields (``StructType.add`` mutates)."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in fields])


# --- landing files -----------------------------------------------------------
# transactions_DDMMYYYY.txt: ';'-separated with a header. The amount is read as
# text and normalised (a decimal comma is accepted) before the decimal cast.
LANDING_TRANSACTIONS = _struct(
    ("transaction_id", S), ("transaction_date", TS), ("amount", S),
    ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S))

LANDING_TERMINALS = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
    ("terminal_address", S))

LANDING_BLACKLIST = _struct(("date", D), ("passport", S))

# --- seed tables ---------------------------------------------------------------
SEED_CARDS = _struct(("card_num", S), ("account", S), ("create_dt", D), ("update_dt", D))
SEED_ACCOUNTS = _struct(("account", S), ("valid_to", D), ("client", S),
                        ("create_dt", D), ("update_dt", D))
SEED_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
    ("phone", S), ("create_dt", D), ("update_dt", D))

# --- warehouse -----------------------------------------------------------------
SCD2_COLUMNS = ("effective_from", "effective_to", "deleted_flg")
SCD2_FIELDS = (("effective_from", TS), ("effective_to", TS), ("deleted_flg", I))

DIM_CARDS = _struct(("card_num", S), ("account", S), *SCD2_FIELDS)
DIM_ACCOUNTS = _struct(("account", S), ("valid_to", D), ("client", S), *SCD2_FIELDS)
DIM_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
    ("phone", S), *SCD2_FIELDS)
DIM_TERMINALS = _struct(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                        ("terminal_address", S), *SCD2_FIELDS)
# The terminal history as it is stored: rows with the version that made them, and the log of
# what a version changes.
TERMINAL_STATE = extend(DIM_TERMINALS, ("version", I))
TERMINAL_LOG = _struct(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                       ("terminal_address", S), ("version", I), ("kind", S), ("at", TS),
                       ("deleted_flg", I))

FACT_BLACKLIST = _struct(("passport_num", S), ("entry_dt", D))
FACT_TRANSACTIONS = _struct(
    ("trans_id", S), ("trans_date", TS), ("card_num", S), ("opertype", S),
    ("amt", AMT), ("oper_result", S), ("terminal", S))

FACT_TRANSACTIONS_STORED = extend(FACT_TRANSACTIONS, ("trans_dt", D), ("load_dt", D))
FACT_BLACKLIST_STORED = extend(FACT_BLACKLIST, ("load_dt", D))

REP_FRAUD = _struct(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
                    ("event_type", S), ("report_dt", TS))
# Column names of the audit table and the report view are fixed values, too.
META_LOG = _struct(("event_dt", TS), ("event_type", S), ("event_desription", S))
REP_FRAUD_STORED = extend(REP_FRAUD, ("load_dt", D))
# One row a commit of a business date; first_dt, last_dt and loaded: days and number of the
# transactions that it stored.
LEDGER = _struct(("terminals_version", I), ("parent_version", I), ("processed_at", TS),
                 ("business_date", D), ("commit_no", I), ("first_dt", D), ("last_dt", D),
                 ("loaded", T.LongType()))

REPORT_COLUMNS = ("event_dt", "passport", "fio", "phone", "event_type")
VIEW_COLUMNS = ("trans_id", "trans_date", "oper_result", "card_num", "amt", "opertype",
                "client", "valid_to", "account", "passport_num", "passport_valid_to",
                "fio", "phone", "terminal_city")
