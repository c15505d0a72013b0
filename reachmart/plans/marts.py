"""Customer profile, segments and cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.functions.decisions import DEFAULT_NAME, UNCLASSIFIED, segment_name, segment_score
from reachmart.functions.temporal import Instant, days_before, since, timestamp_text
from reachmart.functions.text import or_default
from reachmart.operators import activity
from reachmart.plans import staging
from reachmart.sources.schemas import CUSTOMER_COLUMNS, DIM_COLUMNS, PROFILE_COLUMNS, RECORD_COLUMNS


def customer_360(
    tables, as_of: Instant, columns: list[str] | None = None, only: DataFrame | None = None
) -> DataFrame:
    """One row per customer with history and trailing activity.

    ``columns`` names the columns a caller needs. Without the columns that look at the whole
    history, the facts are only read as far back as the longest window reaches. ``only``
    restricts the profile to some customer ids, before their facts are shuffled.
    """
    columns = columns or PROFILE_COLUMNS
    wanted = set(columns)

    def chosen(rows: DataFrame) -> DataFrame:
        return rows if only is None else rows.join(only.select("customer_id"), "customer_id", "left_semi")

    own = [name for name in CUSTOMER_COLUMNS if name in wanted or name == "customer_id"]
    profile = chosen(staging.customers(tables, own))
    if wanted & {"orders_cnt", "lifetime_revenue", "revenue_12wk", "revenue_90d"}:
        whole = wanted & {"orders_cnt", "lifetime_revenue"}
        orders = chosen(staging.orders(tables, None if whole else days_before(as_of, 90)))
        profile = profile.join(activity.order_stats(orders, as_of), "customer_id", "left")
    if wanted & {"last_event_ts", "events_30d"}:
        whole = "last_event_ts" in wanted
        events = chosen(staging.web_events(tables, None if whole else days_before(as_of, 30)))
        profile = profile.join(activity.event_stats(events, as_of), "customer_id", "left")
    return profile.select(*[_zero_if_absent(name) for name in columns])


def _zero_if_absent(name: str) -> Column:
    if name in ("orders_cnt", "events_30d"):
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)
    if name in ("lifetime_revenue", "revenue_12wk", "revenue_90d"):
        return F.coalesce(F.col(name), F.lit(0.0)).alias(name)
    return F.col(name)


def dim_customer(tables, as_of: Instant) -> DataFrame:
    return customer_360(tables, as_of, DIM_COLUMNS)


SCORE_INPUTS = ["revenue_90d", "events_30d", "nps_score"]


def with_segment(profile: DataFrame) -> DataFrame:
    inputs = [F.col(name) for name in SCORE_INPUTS]
    return profile.withColumns({"segment": segment_name(*inputs), "score": segment_score(*inputs)})


def segment_scores(tables, as_of: Instant) -> DataFrame:
    """Reads 90 days of orders and 30 days of events, not their history."""
    return scores_of(customer_360(tables, as_of, ["customer_id", "email", *SCORE_INPUTS]))


def scores_of(profile: DataFrame) -> DataFrame:
    return with_segment(profile).select("customer_id", "email", "segment", "score")


def lookback_revenue(tables, as_of: Instant) -> DataFrame:
    """Trailing paid revenue of the customers who have any."""
    orders = staging.orders(tables, days_before(as_of, 90))
    recent = orders.filter((F.col("status") == activity.PAID) & since(F.col("order_ts"), as_of, 90))
    return activity.order_stats(recent, as_of).select("customer_id", "revenue_12wk", "revenue_90d")


def cohort_retention(tables) -> DataFrame:
    return activity.weekly_cohorts(staging.orders(tables))


def first_order(tables) -> DataFrame:
    return activity.first_orders(staging.orders(tables))


# --- the record handed to decisions and destinations ----------------------------------


def segment_records(profile: DataFrame, segment: str = "all") -> DataFrame:
    """Records of one segment, or of every classified customer, from the profile.

    Scores and profile have the same key and come from the same rows, so the score is a
    further column of the profile and no join takes place. A narrow profile gives a narrow
    record: ``record_inputs`` names the profile columns that a set of record columns needs.
    """
    return _records(with_segment(profile), segment)


def best_records(tables, as_of: Instant, segment: str, n: int = 2) -> DataFrame:
    """The ``n`` records of a segment with the highest scores. The scores need a look at the
    windows only; the whole history is then read for these customers alone."""
    scores = segment_scores(tables, as_of).filter(F.col("segment") == segment)
    best = scores.orderBy(F.desc("score"), "customer_id").limit(n)
    return segment_records(customer_360(tables, as_of, only=best), segment).orderBy(F.desc("score"), "customer_id")


def record_inputs(columns: list[str]) -> list[str]:
    own = [name for name in columns if name in PROFILE_COLUMNS]
    return [*own, *[name for name in SCORE_INPUTS if name not in own]]


def segment_records_from_marts(scores: DataFrame, profile: DataFrame, segment: str = "all") -> DataFrame:
    """The same from two stored marts: scores LEFT JOIN profile."""
    return _records(scores.join(profile.drop("email"), "customer_id", "left"), segment)


def _records(scored: DataFrame, segment: str) -> DataFrame:
    name = F.col("segment")
    chosen = scored.filter(name != UNCLASSIFIED if segment == "all" else name == segment)
    return chosen.select(*[_record_column(name) for name in RECORD_COLUMNS if name in scored.columns])


def _record_column(name: str) -> Column:
    """Nothing missing but the NPS answer: names, places and days get a text, numbers a zero."""
    value = F.col(name)
    if name in ("events_30d", "orders_cnt"):
        value = F.coalesce(value, F.lit(0))
    elif name == "lifetime_revenue":
        value = F.coalesce(value, F.lit(0.0))
    elif name == "first_name":
        value = or_default(value, DEFAULT_NAME)
    elif name == "country":
        value = or_default(value, "Unknown")
    elif name == "created_at":
        value = F.coalesce(value.cast("string"), F.lit("N/A"))
    elif name == "last_event_ts":
        value = F.coalesce(timestamp_text(value), F.lit("N/A"))
    return value.alias(name)
