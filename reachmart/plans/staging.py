"""Typed inputs.

Ids are 64-bit: an events table of some terabytes has more rows than a 32-bit id can count.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from reachmart.functions.temporal import week_start
from reachmart.sources.schemas import CUSTOMER_COLUMNS


def customers(tables, columns: list[str] = CUSTOMER_COLUMNS) -> DataFrame:
    # Half-even rounding, as "9.5" in a seed must not be cut off.
    nps = F.bround(F.col("nps_score").cast("double")).cast("int")
    typed = {
        "customer_id": F.col("customer_id").cast("bigint"),
        "email": F.lower("email"),
        "created_at": F.col("created_at").cast("date"),
        "marketing_opt_in": F.coalesce(F.col("marketing_opt_in").cast("int"), F.lit(0)),
        "nps_score": nps,
    }
    return tables.customers(columns).select(*[typed.get(name, F.col(name)).alias(name) for name in columns])


def orders(tables, since: datetime | None = None) -> DataFrame:
    return tables.orders(since).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
        "status",
        F.col("amount").cast("double").alias("amount"),
    )


def web_events(tables, since: datetime | None = None) -> DataFrame:
    return tables.web_events(since).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "event_type",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        "session_id",
    )


def ad_spend(tables) -> DataFrame:
    return tables.ad_spend().select(
        F.col("date").cast("date").alias("date"),
        "channel",
        "campaign",
        F.col("spend").cast("double").alias("spend"),
    )


def fct_orders(tables, since: datetime | None = None) -> DataFrame:
    return orders(tables, since).withColumn("order_week", week_start(F.col("order_ts")))


def fct_events(tables, since: datetime | None = None) -> DataFrame:
    facts = web_events(tables, since).drop("session_id")
    return facts.withColumn("event_week", week_start(F.col("event_ts")))
