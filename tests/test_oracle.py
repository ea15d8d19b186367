"""Layer 1: every registered query against its DuckDB twin (sf0.001)."""

import re

import duckdb
import pytest

import __spark_entry__ as ENTRY
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

# the training-data queries have their own tests, next to their subpackage
NAMES = sorted(n for n in ENTRY.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create or replace view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = ENTRY.queries()[name](spark, SF_SMALL).toPandas()
    sql = ENTRY.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.sql(sql).df()
    gc, gr, gh = digest(got)
    wc, wr, wh = digest(want)
    assert gc == wc
    assert len(got) == len(want)
    assert gh == wh, (sorted(set(gr) - set(wr))[:2], sorted(set(wr) - set(gr))[:2])


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.columns == ["rel_path", "section", "value"]
    assert df.count() > 0
