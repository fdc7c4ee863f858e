"""Every registered SQL key against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import os

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from tools.compare import digest, duck

SQL_KEYS = sorted(entry.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="no generated tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)


def test_every_query_has_a_registered_callable():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type"]
    assert df.count() > 0
