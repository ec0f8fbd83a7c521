"""Every registered query against its SQL in DuckDB.

SF_DIR picks the data (default: the smallest set), QUERY a part of the names.
"""

import os
import time
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from gleanfield.plans.catalog import QUERIES

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
PART = os.environ.get("QUERY", "")
NAMES = [n for n in QUERIES if PART in n]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    start = time.time()
    df = QUERIES[name](spark, FOLDER)
    got = comparable(df.columns, df.collect())
    took = time.time() - start
    expected = duck.sql(oracle_sql()[name])
    wanted = comparable(expected.columns, expected.fetchall())
    print(f"{name}: {len(got)} rows, {took:.1f} s")
    assert sorted(df.columns) == sorted(expected.columns)
    missing, extra = sorted(set(wanted) - set(got)), sorted(set(got) - set(wanted))
    assert not missing and not extra, (len(missing), len(extra), missing[:2], extra[:2])
    assert len(got) == len(wanted) and got


def test_entry(spark):
    assert entry(spark).count() > 0
