import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402


def test_entry_runs_on_smallest_scale(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["rating", "0", "1"]


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_duckdb_oracle(spark, sf_small, name):
    con = _con(sf_small)
    sdf = entry.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


_CON = {}


def _con(sf):
    if sf not in _CON:
        _CON[sf] = duck(sf)
    return _CON[sf]


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_model_query_runs(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    assert df.count() >= 1
