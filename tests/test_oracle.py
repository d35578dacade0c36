"""Every registered query equals its SQL oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_util import duck, rows_equal

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    rows_equal(QUERIES[name](spark, SF), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_has_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    assert not [c for c in df.columns if c.startswith("__")], df.columns  # no helper columns leak


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["returning_buyers"] > 0
