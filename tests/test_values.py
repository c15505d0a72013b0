"""Time and money expressions against plain Python, on random values."""

import math
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reachmart.functions import money, temporal


def moments(n):
    draw = random.Random(6)
    start = datetime(1960, 1, 1)
    values = [start + timedelta(microseconds=draw.randrange(100 * 366 * 86_400 * 10**6)) for _ in range(n)]
    values += [moment.replace(microsecond=0) for moment in values[:50]]
    values += [datetime(2024, 1, 1), datetime(2024, 1, 7, 23, 59, 59, 999_999), datetime(2023, 12, 31, 0, 0, 0, 500_000)]
    return values


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu", "America/Sao_Paulo"])
def test_weeks_and_texts_in_any_session_zone(spark, column, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = moments(300)
        rows = [(value.isoformat(sep=" "),) for value in values]
        ts = F.col("ts").cast("timestamp_ntz")
        weeks = column(rows, "ts string", temporal.week_start(ts))
        monday = [datetime.combine(v.date() - timedelta(days=v.weekday()), datetime.min.time()) for v in values]
        assert weeks == monday
        assert column(rows, "ts string", temporal.timestamp_text(ts)) == [str(value) for value in values]
        days = column([(str(v.date()),) for v in values], "d string", temporal.parsed_day(F.col("d")))
        assert days == [str(v.date()) for v in values]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_as_of_forms():
    expected = datetime(2024, 1, 31)
    for value in ("2024-01-31", "2024-01-31 00:00:00", "2024-01-31T01:00:00+01:00", expected):
        assert temporal.as_datetime(value) == expected
    assert temporal.days_before("2024-03-01", 30) == datetime(2024, 1, 31)
    assert temporal.days_before("2024-03-30", 90).date() == date(2023, 12, 31)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-(10**9), max_value=10**9), min_size=1, max_size=60))
def test_sums_of_cents_are_exact(spark, cents):
    """Whatever the order and the number of tasks, the sum is the nearest double of the true one."""
    rows = [(value / 100,) for value in cents]
    expected = float(sum(Decimal(value) for value in cents) / 100)
    for tasks in (1, 7):
        frame = spark.createDataFrame(rows, "x double").repartition(tasks)
        assert frame.agg(money.exact_sum(F.col("x"))).collect()[0][0] == expected


def test_sums_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "x double")
    assert tuple(frame.agg(money.exact_sum(F.col("x")), money.exact_mean(F.col("x"))).collect()[0]) == (None, None)


@pytest.mark.parametrize(
    "rows,total",
    [
        ([9e14] * 3000, 3000 * 9e14),
        ([0.00004] * 100, 0.004),
        ([2e15], 2e15),
        ([1e-12, 1.0], 1.000000000001),
        ([0.1, 2e15, -2e15], 0.1),
        ([-0.00005, 0.1, None], 0.09995),
        ([float("inf"), 1.0], float("inf")),
    ],
)
def test_no_amount_is_cut(spark, rows, total):
    frame = spark.createDataFrame([(x,) for x in rows], "x double").repartition(3)
    assert frame.agg(money.exact_sum(F.col("x"))).collect()[0][0] == total


def test_what_is_no_number_shows(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert math.isnan(frame.agg(money.exact_sum(F.col("x"))).collect()[0][0])


def test_a_total_that_does_not_fit_fails(spark):
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE"):
        spark.createDataFrame([(9e30,)], "x double").agg(money.exact_sum(F.col("x"))).collect()

