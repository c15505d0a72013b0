"""Data tests: one row per test with the number of failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

REPORT_COLUMNS = ["test", "model", "column_name", "failures", "passed"]


def _row(result: DataFrame, test: str, model: str, column: str) -> DataFrame:
    return result.select(
        F.lit(test).alias("test"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.col("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def not_null(rows: DataFrame, model: str, column: str) -> DataFrame:
    """Fails on each row without a value."""
    return _row(rows.agg(F.count_if(F.col(column).isNull()).alias("failures")), "not_null", model, column)


def unique(rows: DataFrame, model: str, column: str) -> DataFrame:
    """Fails on each value that occurs more than once; missing values do not count."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return _row(counts.agg(F.count_if(F.col("n") > 1).alias("failures")), "unique", model, column)


def model_tests(rows: DataFrame, model: str, tests: list[tuple[str, str, list[str] | None]]) -> DataFrame:
    """All tests (name, column, accepted values) of a model from one read and one grouping.

    Every row gives a (column, value) pair for each tested column; equal pairs are counted
    before they are shuffled. A column that is only tested for presence gives no values.
    """
    valued = {column for test, column, _ in tests if test != "not_null"}
    columns = list(dict.fromkeys(column for _, column, _ in tests))
    pairs = [
        F.struct(
            F.lit(column).alias("tested"),
            (F.col(column).cast("string") if column in valued else F.when(F.col(column).isNotNull(), "")).alias("value"),
        )
        for column in columns
    ]
    counts = rows.select(F.inline(F.array(*pairs))).groupBy("tested", "value").agg(F.count("*").alias("n"))
    missing = F.col("value").isNull()
    failures = {
        "not_null": lambda of, _: F.coalesce(F.sum(F.when(of & missing, F.col("n"))), F.lit(0)),
        "unique": lambda of, _: F.count_if(of & ~missing & (F.col("n") > 1)),
        "accepted_values": lambda of, values: F.count_if(of & ~missing & ~F.col("value").isin(values or [])),
    }
    found = [failures[test](F.col("tested") == column, values) for test, column, values in tests]
    totals = counts.agg(*[f.alias(f"t{i}") for i, f in enumerate(found)])
    lines = [
        F.struct(F.lit(test).alias("test"), F.lit(column).alias("column_name"), F.col(f"t{i}").alias("failures"))
        for i, (test, column, _) in enumerate(tests)
    ]
    result = totals.select(F.inline(F.array(*lines)))
    passed = (F.col("failures") == 0).alias("passed")
    return result.select("test", F.lit(model).alias("model"), "column_name", "failures", passed)


def accepted_values(rows: DataFrame, model: str, column: str, values: list[str]) -> DataFrame:
    """Fails on each distinct value outside the list; missing values pass."""
    others = rows.filter(~F.col(column).isin(values)).select(column).distinct()
    return _row(others.agg(F.count("*").alias("failures")), "accepted_values", model, column)


def report(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
