"""The queries that have SQL, on the smallest tables."""

import pytest

import compare
from reachmart.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_same_rows_as_sql(spark, name):
    assert name in queries.QUERIES
    assert compare.difference(spark, compare.open_tables(FOLDER), FOLDER, name) is None


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
