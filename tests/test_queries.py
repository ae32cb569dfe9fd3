"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import connect, difference

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
#: Queries that may find nothing in the smallest tables.
MAY_BE_EMPTY = {"recent_logs_run"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
    assert set(entry.queries()) - set(ORACLES) <= set(entry.LLM_QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    if name not in ORACLES:
        assert len(ours)
        return
    expected = connect(FOLDER).sql(ORACLES[name]).df()
    problem = difference(ours, expected)
    assert problem == "" or (problem == "no rows" and name in MAY_BE_EMPTY)
