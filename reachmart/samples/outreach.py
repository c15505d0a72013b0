"""Outreach inputs derived from the customer table: hand-entered records with the usual
mistakes, a ledger of earlier campaigns, and records as a destination may receive them.

The mistakes are spread by customer number, so that every repair rule has work at every
scale; every customer gives one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.functions.decisions import CHURN_RESCUE, FIRST_WEEK_INTENT, LAPSE_RISK
from reachmart.functions.temporal import Instant
from reachmart.plans import manual_entries, staging


def entered_records(tables, as_of: Instant) -> DataFrame:
    """One hand-entered record per customer, some with shifted columns, percentages as
    scores, unreadable dates or actions that are not JSON."""
    key = F.col("customer_id")
    customers = staging.customers(tables)
    segment = (
        F.when(F.col("nps_score") < 7, CHURN_RESCUE)
        .when(F.col("marketing_opt_in") == 1, LAPSE_RISK)
        .otherwise(FIRST_WEEK_INTENT)
    )
    score = (
        F.when(key % 5 == 0, (key % 101).cast("string"))
        .when(key % 17 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("0."), key % 10))
    )
    forms = customers.select(
        key.alias("form"),
        "email",
        "first_name",
        segment.alias("segment"),
        score.alias("score"),
        F.col("nps_score").cast("string").alias("nps_score"),
        F.lit("0").alias("events_30d"),
        F.lit("0").alias("orders_cnt"),
        F.lit("0.0").alias("lifetime_revenue"),
        "country",
    )
    entries = manual_entries.new_entries(forms, as_of, F.col("form"))
    number = F.substring_index("customer_id", "-", -1).cast("bigint")
    name, segment, action = F.col("first_name"), F.col("segment"), F.col("nba_action")
    return entries.withColumns(
        {
            "first_name": F.when(number % 7 == 0, segment).otherwise(name),
            "segment": F.when(number % 7 == 0, name).when(number % 23 == 1, F.lit("0.75")).otherwise(segment),
            "created_at": F.when(number % 11 == 0, "not a date")
            .when(number % 11 == 1, "12/25/2023")
            .otherwise(F.col("created_at")),
            "nba_action": F.when(number % 3 == 0, action)
            .when(number % 3 == 1, F.replace(action, F.lit('"'), F.lit("'")))
            .otherwise("oops"),
        }
    )


def sent_records(tables) -> DataFrame:
    """Earlier campaigns: machinery customers are known by id, furniture customers by
    e-mail only."""
    campaign = F.lower("last_name")
    by_id, by_email = campaign == "machinery", campaign == "furniture"
    customers = staging.customers(tables, ["customer_id", "email", "first_name", "last_name"]).filter(by_id | by_email)
    return customers.select(
        F.when(by_id, F.concat(F.lit("manual-"), F.col("customer_id"))).alias("customer_id"),
        F.when(by_email, F.col("email")).alias("email"),
        F.lit(CHURN_RESCUE).alias("segment"),
        F.lit(0.5).alias("score"),
        "first_name",
        F.lit(None).cast("string").alias("nba_action"),
        F.concat(campaign, F.lit("_payload")).alias("source"),
        campaign.alias("run_id"),
    )


def lookup_keys(tables) -> DataFrame:
    """One key per customer: an id, an e-mail in other case, or one that nobody has."""
    key = F.col("customer_id").cast("string")
    group = F.col("last_name")
    return staging.customers(tables, ["customer_id", "email", "last_name"]).select(
        F.when(group == "HOUSEHOLD", F.concat(F.lit("manual-"), key))
        .when(group == "BUILDING", F.upper("email"))
        .otherwise(F.concat(F.lit("nobody-"), key))
        .alias("lookup")
    )


def delivered_records(payload: DataFrame) -> DataFrame:
    """Payload rows with the mix-ups that the lead job repairs."""
    key = F.col("customer_id")
    text, name, email = key.cast("string"), F.col("first_name"), F.col("email")
    return payload.withColumns(
        {
            "number": key,
            "customer_id": _by_rest(key, {2: email, 4: F.lit("unknown")}, text),
            "first_name": _by_rest(key, {1: email, 3: F.lit("0.75"), 5: F.lit("42")}, name),
            "email": _by_rest(key, {1: name, 2: F.lit("n/a"), 5: F.lit("n/a")}, email),
        }
    )


def _by_rest(key: Column, values: dict[int, Column], otherwise: Column) -> Column:
    branch = F
    for rest, value in values.items():
        branch = branch.when(key % 7 == rest, value)
    return branch.otherwise(otherwise)
