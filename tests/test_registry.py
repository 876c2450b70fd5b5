"""Every registered query against its SQL, and the entry point."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck
from tributary.registry.oracles import ORACLES
from tributary.registry.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", list(oracle_sql()))
def test_query_matches_sql(spark, con, key):
    problem, n = compare(spark, con, SF, key, queries()[key], oracle_sql()[key])
    assert problem is None
    assert n >= 0


def test_every_query_has_sql():
    """Of the optional ones, those that SQL can't express are held against brute force."""
    assert set(REGISTRY) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["committee_id", "name", "label", "total_raised", "party_class"]
    assert df.count() == 12
