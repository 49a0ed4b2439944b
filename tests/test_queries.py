"""Every registered query with an oracle equals its DuckDB formulation on
the smallest fixture tables (the driver checks sf0.01)."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from textmill.plans import registry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

KEYS = sorted(registry.ORACLE)
ROWS_ONLY = sorted(set(registry.QUERIES) - set(registry.ORACLE))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"language", "outcome", "n"}


def test_every_query_has_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_query_without_oracle_gives_rows(spark, key):
    assert registry.QUERIES[key](spark, SF_SMALL).count() > 0
