"""Every query with a SQL counterpart gives the same rows in both engines."""

from __future__ import annotations

import os

import oracle
import pytest

from firmlens.plans import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = oracle.spark_rows(QUERIES[name](spark, SF))
    assert oracle.difference(got, oracle.duck_rows(duck, ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()
