"""Every query that SQL can say, beside its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()
# dozens of fits each; run by oracle_check.py, their parts by the tests beside this one
LONG = {f"recipe_score_c{i}" for i in range(6)} | {"segment_score"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG))
def test_same_as_sql(spark, con, folder, name):
    assert compare(spark, con, folder, QUERIES[name], ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["cluster", "n", "n_pos", "n_neg", "pct_pos"]
    assert df.count() > 0
