"""Every registered query against its SQL, or for its rows, at the smallest scale."""

import pytest
from oracle import difference

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Long fits; their operators are tested with fewer trees in test_learning.py.
LONG = {"clf_gbt", "reg_gbt", "cross_validate", "clf_logistic"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), ORACLES[name], folder) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_has_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"series_id", "event_id", "value", "z"}


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
