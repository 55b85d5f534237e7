"""Queries that SQL can express against their SQL; all others run whole."""

import pytest

import __spark_entry__ as E
from skyledger.llm.queries import ORACLE, QUERIES
from tools.oracle_check import duck, rows_of

from ..conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(cols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(cols, res.fetchall())


def test_one_query_for_each_operator():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
