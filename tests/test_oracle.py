"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as E
from skyledger.registry import QUERIES as BASE
from tools.oracle_check import duck, rows_of

from .conftest import SF_SMALL

QUERIES = BASE
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in BASE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_cols, d_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["created_at", "passenger_id", "passenger_name", "flights_number", "purchase_sum",
                          "home_airport", "customer_group"]
    assert df.count() > 0
