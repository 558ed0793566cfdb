"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry
from sessionloom.plans import catalogue

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.QUERIES, catalogue.ORACLE


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"label", "n_events", "n_sessions", "n_samples", "median_duration_s"}
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _ = oracle.compare(spark, con, QUERIES[name], SQL.get(name), SF)
    assert problem is None
