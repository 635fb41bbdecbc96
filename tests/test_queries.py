"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver entry point."""

import pytest

from helpers import SF_SMALL
from matchlog.plans.catalog import QUERIES
from matchlog.plans.oracle import oracle_sql
from oracle_check import compare, duck

import __spark_entry__ as entry_mod

ORACLE = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(ORACLE) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["log_id", "match_id", "category", "n"]
    assert df.count() > 0
