"""Every registered query against its DuckDB SQL on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from opslog.plans.registry import QUERIES
from tools.compare import TABLES, digest

SF = os.environ.get("OPSLOG_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    want = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(ocols, want)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["Name", "TimesRun", "AvgProcTimeMS", "LastRunDate"]
    assert df.count() > 0
