"""Per-customer aggregates. Each reads its facts once, and every aggregate has a map-side
part, so a customer who owns a third of the rows sends one row per task to the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.functions.money import exact_sum
from reachmart.functions.temporal import Instant, monday, since

PAID = "paid"


def order_stats(orders: DataFrame, as_of: Instant) -> DataFrame:
    """Order count, lifetime revenue and both trailing revenues in one pass."""
    ts, amount = F.col("order_ts"), F.col("amount")
    paid = F.col("status") == PAID
    return orders.groupBy("customer_id").agg(
        F.count("*").alias("orders_cnt"),
        exact_sum(F.when(paid, amount)).alias("lifetime_revenue"),
        exact_sum(F.when(paid & since(ts, as_of, 84), amount)).alias("revenue_12wk"),
        exact_sum(F.when(paid & since(ts, as_of, 90), amount)).alias("revenue_90d"),
    )


def event_stats(events: DataFrame, as_of: Instant) -> DataFrame:
    ts = F.col("event_ts")
    return events.groupBy("customer_id").agg(
        F.max(ts).alias("last_event_ts"),
        F.count_if(since(ts, as_of, 30)).alias("events_30d"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    paid = orders.filter(F.col("status") == PAID)
    return paid.groupBy("customer_id").agg(F.min("order_ts").alias("first_order_ts"))


def rolling_count(ts: Column, as_of: Instant, window_days: int = 30) -> Column:
    """Aggregate: rows within the last days; null for no input rows at all."""
    return F.sum(F.when(since(ts, as_of, window_days), 1).otherwise(0))


def weekly_cohorts(orders: DataFrame) -> DataFrame:
    """Active customers by week of first paid order and week of order.

    The week of the first order is the first of the customer's weeks, so no second read of
    the orders and no join is needed. The set of weeks of one customer is bounded by the
    age of the data and is built on the map side; the counts need no further distinct.
    Orders without a time form a week of their own, after all others in the set.
    """
    undated = F.lit("9999-12-27").cast("date")
    week = F.coalesce(monday(F.col("order_ts")), undated)
    weeks = (
        orders.filter((F.col("status") == PAID) & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.collect_set(week).alias("weeks"))
    )
    return (
        weeks.select(F.array_min("weeks").alias("first"), F.explode("weeks").alias("week"))
        .groupBy(
            F.nullif("first", undated).cast("timestamp_ntz").alias("cohort_week"),
            F.nullif("week", undated).cast("timestamp_ntz").alias("order_week"),
        )
        .agg(F.count("*").alias("active_customers"))
    )
