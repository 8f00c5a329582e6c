"""Every registered query with an oracle equals its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import duck, rows

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert set(df.columns) == {"flag", "value", "n"}
