"""Queries that SQL can express, on the smallest tables."""

import os

import pytest

from perkwell.llm.queries import ORACLE_SQL, QUERIES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIRECTORY)
    order = sorted(df.columns)
    result = duck.execute(ORACLE_SQL[name])
    place = {d[0]: i for i, d in enumerate(result.description)}
    theirs = sorted(repr([r[place[c]] for c in order]) for r in result.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in df.collect()) == theirs
