"""Every registered query with an oracle agrees with DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, E.queries()[name], ORACLES[name], SF, con)
    assert info["ok"], info


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["class", "precision", "recall", "f1", "support"]
