from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cardwatch.config import build_session, shared_root
    s = build_session("local[4]", app="cardwatch-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # The scratch root comes from the session's spark.checkpoint.dir; only when
    # the environment names none does shared_root create a test folder.
    shared_root(s)
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


VIEW_SCHEMA = ("trans_id string, trans_date timestamp_ntz, oper_result string, card_num string, "
               "amt decimal(12,2), opertype string, client string, valid_to date, "
               "account string, passport_num string, passport_valid_to date, fio string, "
               "phone string, terminal_city string")


def view_rows(spark, rows: list[dict]):
    """A report view from partial dicts (missing columns are NULL)."""
    from decimal import Decimal
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(VIEW_SCHEMA)
    names = schema.fieldNames()
    out = []
    for r in rows:
        r = dict(r)
        if isinstance(r.get("trans_date"), str):
            r["trans_date"] = ts(r["trans_date"])
        for k in ("valid_to", "passport_valid_to"):
            if isinstance(r.get(k), str):
                r[k] = d(r[k])
        if r.get("amt") is not None and not isinstance(r["amt"], Decimal):
            r["amt"] = Decimal(str(r["amt"]))
        out.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(out, schema)
