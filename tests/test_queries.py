"""Every registered query against its SQL, on whole tables."""

from dataclasses import replace

import pytest

import __spark_entry__ as contract
from loanloom import catalog
from oracle import connect, difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture
def few_trees(monkeypatch):
    """The registered functions as they are, with short forests; depth and rates stay."""
    whole = catalog.ModelParams
    monkeypatch.setattr(catalog, "ModelParams", lambda: whole(trees=3))
    short = {k: replace(p, trees=3) for k, p in catalog.RANKING_PARAMS.items()}
    monkeypatch.setattr(catalog, "RANKING_PARAMS", short)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_against_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, sf_dir, few_trees, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_only_for_registered_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1500 and "has_bureau_history" in df.columns
