"""Aggregates over the marts, as a dashboard shows them. Each reads only the columns it
needs; nothing but the aggregate leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reachmart.functions.decisions import discount_text, nps_class
from reachmart.functions.money import as_double, exact_mean, exact_sum, exact_total, odd_total
from reachmart.functions.temporal import Instant
from reachmart.functions.text import fixed_text
from reachmart.operators.activity import rolling_count
from reachmart.operators.histogram import histogram
from reachmart.plans import marts, staging


def of_country(profile: DataFrame, country: str = "All") -> DataFrame:
    return profile if country == "All" else profile.filter(F.col("country") == country)


KPI_COLUMNS = ["country", "lifetime_revenue", "nps_score", "events_30d"]


def kpis(profile: DataFrame, country: str = "All") -> DataFrame:
    """Customers, revenue, mean NPS and active customers, for one country or all."""
    return of_country(profile, country).agg(
        F.count("*").alias("total_customers"),
        exact_sum(F.col("lifetime_revenue")).alias("total_revenue"),
        _mean_nps().alias("avg_nps"),
        F.count_if(F.col("events_30d") > 0).alias("active_customers"),
    )


def _mean_nps():
    return F.sum("nps_score") / F.nullif(F.count("nps_score"), F.lit(0))


def kpis_by_filter(profile: DataFrame) -> DataFrame:
    """The KPI row of every choice of the country filter: "All" and each country. Countries
    are aggregated first, so the grouping for the total sees one row per country."""
    per_country = profile.groupBy("country").agg(
        F.count("*").alias("customers"),
        exact_total(F.col("lifetime_revenue")).alias("revenue"),
        odd_total(F.col("lifetime_revenue")).alias("odd_revenue"),
        F.sum("nps_score").alias("nps_sum"),
        F.count("nps_score").alias("nps_n"),
        F.count_if(F.col("events_30d") > 0).alias("active"),
    )
    choice = F.explode(F.array(F.lit("All"), F.col("country")))
    choices = per_country.withColumn("country_filter", choice).filter(F.col("country_filter").isNotNull())
    return choices.groupBy("country_filter").agg(
        F.sum("customers").alias("total_customers"),
        as_double(F.sum("revenue"), F.sum("odd_revenue")).alias("total_revenue"),
        (F.sum("nps_sum") / F.nullif(F.sum("nps_n"), F.lit(0))).alias("avg_nps"),
        F.sum("active").alias("active_customers"),
    )


def kpi_display(kpi_rows: DataFrame) -> DataFrame:
    """KPI numbers as text: thousands separators, whole dollars, one decimal for the NPS."""
    return kpi_rows.select(
        *[name for name in ("country_filter",) if name in kpi_rows.columns],
        F.format_number("total_customers", 0).alias("total_customers"),
        F.concat(F.lit("$"), F.format_number(F.bround("total_revenue", 0), 0)).alias("total_revenue"),
        fixed_text(F.col("avg_nps"), 1).alias("avg_nps"),
        F.format_number("active_customers", 0).alias("active_customers"),
    )


def revenue_histogram(profile: DataFrame) -> DataFrame:
    return histogram(profile, "lifetime_revenue", 20)


def nps_histogram(profile: DataFrame) -> DataFrame:
    return histogram(profile, "nps_score", 10)


def revenue_by_country(profile: DataFrame) -> DataFrame:
    known = profile.filter(F.col("country").isNotNull())
    return known.groupBy("country").agg(exact_sum(F.col("lifetime_revenue")).alias("lifetime_revenue"))


def segment_counts(scores: DataFrame) -> DataFrame:
    counts = scores.groupBy("segment").agg(F.count("*").alias("customers"))
    return counts.orderBy(F.desc("customers"), "segment")


def segment_performance(profile: DataFrame) -> DataFrame:
    """Means per segment, unrounded; scores are a column of the profile (no join)."""
    return _performance(marts.with_segment(profile))


def segment_performance_from_marts(scores: DataFrame, profile: DataFrame) -> DataFrame:
    """The same from two stored marts: scores LEFT JOIN profile on the customer."""
    return _performance(scores.join(profile.drop("email"), "customer_id", "left"))


def _performance(scored: DataFrame) -> DataFrame:
    return scored.groupBy("segment").agg(
        exact_mean(F.col("lifetime_revenue")).alias("lifetime_revenue"),
        _mean_nps().alias("nps_score"),
        exact_mean(F.col("score")).alias("score"),
    )


def rounded(performance: DataFrame) -> DataFrame:
    """For display only: means with two decimals."""
    means = ("lifetime_revenue", "nps_score", "score")
    return performance.withColumns({name: F.bround(name, 2) for name in means})


def nps_categories(profile: DataFrame) -> DataFrame:
    return profile.groupBy(nps_class(F.col("nps_score")).alias("category")).agg(F.count("*").alias("customers"))


ACTIVITY_COLUMNS = ["customer_id", "email", "country", "events_30d", "orders_cnt", "lifetime_revenue", "nps_score"]


def recent_activity(profile: DataFrame) -> DataFrame:
    """Customers active within 30 days, most active first."""
    active = profile.filter(F.col("events_30d") > 0).select(*ACTIVITY_COLUMNS)
    return active.orderBy(F.desc("events_30d"), "customer_id")


def top_active(profile: DataFrame, n: int = 5) -> DataFrame:
    """The report's top list from a stored profile; one top-k without a full sort."""
    return recent_activity(profile).select(*TOP_COLUMNS).limit(n)


def top_active_of(tables, as_of: Instant, n: int = 5) -> DataFrame:
    """The same from the facts: 30 days of events decide, and only the winners' orders are
    added up."""
    activity = marts.customer_360(tables, as_of, ["customer_id", "events_30d"])
    active = activity.filter(F.col("events_30d") > 0)
    winners = active.orderBy(F.desc("events_30d"), "customer_id").limit(n)
    rows = marts.customer_360(tables, as_of, TOP_COLUMNS, only=winners)
    return rows.orderBy(F.desc("events_30d"), "customer_id")


TOP_COLUMNS = ["customer_id", "email", "events_30d", "lifetime_revenue"]


def filter_values(profile: DataFrame, scores: DataFrame) -> DataFrame:
    """The choices of the dashboard's filters."""
    countries = profile.select(F.lit("country").alias("filter"), F.col("country").alias("value"))
    segments = scores.select(F.lit("segment").alias("filter"), F.col("segment").alias("value"))
    return countries.distinct().unionByName(segments.distinct())


def events_in_window(tables, as_of: Instant) -> DataFrame:
    """The rolling count per event type, for the default window and for a week."""
    events = staging.web_events(tables)
    ts = F.col("event_ts")
    return events.groupBy("event_type").agg(
        rolling_count(ts, as_of).alias("events_30d"),
        rolling_count(ts, as_of, 7).alias("events_7d"),
    )


# --- reports on payloads ----------------------------------------------------------------


def flat_actions(payload: DataFrame) -> DataFrame:
    action = F.col("nba_action")
    return payload.select(
        "customer_id",
        "email",
        "segment",
        "score",
        F.coalesce(action["channel"], F.lit("N/A")).alias("Channel"),
        F.coalesce(action["template"], F.lit("N/A")).alias("Template"),
        discount_text(action).alias("Discount"),
    )


def risk_display(scored: DataFrame, risk: str = "llm_risk_score") -> DataFrame:
    """Risk with three decimals, or N/A."""
    text = F.coalesce(fixed_text(F.col(risk), 3), F.lit("N/A"))
    return scored.select("customer_id", "email", "segment", text.alias("LLM_Risk"))


def messages(payload: DataFrame, message: str = "personalized_message") -> DataFrame:
    """Records that have a message to show."""
    shown = payload.filter(F.col(message).isNotNull() & (F.col(message) != ""))
    return shown.select("customer_id", "email", "segment", message)


def activation_summary(payload: DataFrame) -> DataFrame:
    """Customers per segment and in total; the total adds up the segment rows."""
    per_segment = payload.groupBy("segment").agg(F.count("*").alias("n"))
    line = F.explode(F.array(F.lit("Customers Activated"), F.col("segment"))).alias("line")
    lines = per_segment.select(line, "n").filter(F.col("line").isNotNull())
    return lines.groupBy("line").agg(F.sum("n").alias("customers"))


def activation_metrics(payload: DataFrame) -> DataFrame:
    """Customers, segments targeted and, where there is one, the mean risk.

    Segments are grouped first: counting distinct values of a few names needs no second copy
    of the rows.
    """
    risk = _risk_of(payload)
    per_segment = payload.groupBy("segment").agg(
        F.count("*").alias("n"),
        exact_total(risk).alias("risk"),
        odd_total(risk).alias("odd_risk"),
        F.count(risk).alias("risks"),
    )
    total = as_double(F.sum("risk"), F.sum("odd_risk"))
    return per_segment.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("customers_activated"),
        F.count("segment").alias("segments_targeted"),
        (total / F.nullif(F.sum("risks"), F.lit(0))).alias("avg_risk"),
    )


def validate_run(payload: DataFrame) -> DataFrame:
    """Rows of the last payload and their mean risk; zero rows for an empty payload."""
    risk = _risk_of(payload)
    return payload.agg(F.count("*").alias("activated"), exact_mean(risk).alias("avg_risk"))


def _risk_of(payload: DataFrame):
    known = "llm_risk_score" in payload.columns
    return F.col("llm_risk_score") if known else F.lit(None).cast("double")

