"""Layer 2b/3: every registered query against its DuckDB oracle on the small test tables, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from kestrel.plans.catalog import CATALOG, SINK_QUERIES
from tests.harness import compare, duck

QUERIES = {n: entry.queries()[n] for n in [*CATALOG, *SINK_QUERIES]}
ORACLES = {n: entry.oracle_sql()[n] for n in [*CATALOG, *SINK_QUERIES]}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLES)) == []


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], sf_dir, con)
    assert r["cols_match"], r
    assert r["match"], r
