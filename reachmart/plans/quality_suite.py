"""The nine data tests of the models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reachmart.functions.decisions import ALL_SEGMENTS
from reachmart.functions.temporal import Instant
from reachmart.operators import quality
from reachmart.plans import marts, staging

# What the tests cover.
NOT_NULL = [
    ("stg_customers", "customer_id"),
    ("stg_customers", "email"),
    ("dim_customer", "customer_id"),
    ("fct_orders", "order_id"),
]
UNIQUE = [("stg_customers", "customer_id"), ("dim_customer", "customer_id"), ("fct_orders", "order_id")]
ACCEPTED = [("fct_orders", "status", ["paid", "refunded"]), ("segment_scores", "segment", ALL_SEGMENTS)]


MODELS = ["stg_customers", "dim_customer", "fct_orders", "segment_scores"]


def models(tables, as_of: Instant) -> dict[str, DataFrame]:
    return {
        "stg_customers": staging.customers(tables),
        "dim_customer": marts.dim_customer(tables, as_of),
        "fct_orders": staging.fct_orders(tables),
        "segment_scores": marts.segment_scores(tables, as_of),
    }


def not_null_tests(by_name: dict[str, DataFrame]) -> list[DataFrame]:
    return [quality.not_null(by_name[model], model, column) for model, column in NOT_NULL]


def unique_tests(by_name: dict[str, DataFrame]) -> list[DataFrame]:
    return [quality.unique(by_name[model], model, column) for model, column in UNIQUE]


def accepted_tests(by_name: dict[str, DataFrame]) -> list[DataFrame]:
    return [quality.accepted_values(by_name[model], model, column, values) for model, column, values in ACCEPTED]


def suite(by_name: dict[str, DataFrame]) -> DataFrame:
    """All tests; every model is read once."""
    tests = [("not_null", model, column, None) for model, column in NOT_NULL]
    tests += [("unique", model, column, None) for model, column in UNIQUE]
    tests += [("accepted_values", *test) for test in ACCEPTED]
    results = []
    for model in dict.fromkeys(model for _, model, _, _ in tests):
        own = [(test, column, values) for test, of, column, values in tests if of == model]
        results.append(quality.model_tests(by_name[model], model, own))
    return quality.report(results)
