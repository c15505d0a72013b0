"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from reachmart import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


def test_entry(spark):
    rows = entry.entry(spark).groupBy("segment").count().collect()
    assert {row["segment"]: row["count"] for row in rows} == {
        "churn_rescue_nps": 69,
        "high_value_lapse_risk": 22,
        "new_users_first_week_intent": 14,
        "unclassified": 45,
    }
