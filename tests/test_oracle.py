"""Every query gives the same rows as its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from civicledger.plans.catalog import QUERIES
from tools.check import compare, database


@pytest.fixture(scope="module")
def db(small):
    return database(small)


OWN = sorted(set(oracle_sql()) & set(QUERIES))


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, small, db, name):
    got = queries()[name](spark, small).toArrow()
    assert compare(got, db.sql(oracle_sql()[name]).to_arrow_table()) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5
    assert abs(sum(r.collected_share for r in rows) - 1) < 1e-5
    assert abs(sum(r.gap for r in rows)) < 1e-5
