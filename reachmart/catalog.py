"""Every query by name: a function of the session and the folder of input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reachmart.functions import text
from reachmart.functions.cleaning import unit_score
from reachmart.functions.decisions import CHURN_RESCUE, LAPSE_RISK, next_best_action, rule_risk, template_message
from reachmart.functions.temporal import parsed_day
from reachmart.operators import lookups, quality, sent_keys
from reachmart.plans import (
    activation, delivery, manual_entries, marts, quality_suite, reports, scoring, staging, sync, warehouse,
)
from reachmart.session import scratch_dir
from reachmart.samples import answers, outreach
from reachmart.sources import files, outbox
from reachmart.sources.ledger import Ledger
from reachmart.sources.payload_files import PayloadFiles
from reachmart.sources.schemas import RECORD_COLUMNS
from reachmart.sources.tables import SalesTables
from reachmart.streaming import sync_stream

AS_OF = "2024-01-31 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Registers a function of the tables."""

    def register(function: Callable[[SalesTables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(SalesTables(spark, folder))
        return function

    return register


def job(name: str):
    """Registers a function that needs the session, because it writes and reads back."""

    def register(function: Query):
        QUERIES[name] = function
        return function

    return register


# --- shared inputs ----------------------------------------------------------------------


def _profile(tables: SalesTables, *columns: str) -> DataFrame:
    return marts.customer_360(tables, AS_OF, list(columns) or None)


def _records(tables: SalesTables, segment: str = "all", columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    return marts.segment_records(_profile(tables, *marts.record_inputs(columns)), segment)


def _payload(tables: SalesTables, columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    return activation.payload(_records(tables, columns=columns))


# What leads, tasks and most reports use of a record; it needs no look at the whole history.
BRIEF = ["customer_id", "email", "first_name"]


def _scored(tables: SalesTables) -> DataFrame:
    risk = rule_risk(F.col("nps_score"), F.col("events_30d"), F.col("lifetime_revenue"))
    return _records(tables, columns=["customer_id", "email", "lifetime_revenue"]).withColumn("llm_risk_score", risk)


def _entries(tables: SalesTables) -> DataFrame:
    return outreach.entered_records(tables, AS_OF)


def _delivered(tables: SalesTables) -> DataFrame:
    return outreach.delivered_records(_payload(tables, BRIEF))


# --- scans, staging, facts --------------------------------------------------------------


@query("scan_customers")
def scan_customers(tables: SalesTables) -> DataFrame:
    return tables.customers()


@query("scan_orders")
def scan_orders(tables: SalesTables) -> DataFrame:
    return tables.orders()


@query("scan_web_events")
def scan_web_events(tables: SalesTables) -> DataFrame:
    return tables.web_events()


@query("scan_ad_spend")
def scan_ad_spend(tables: SalesTables) -> DataFrame:
    return tables.ad_spend()


@query("stg_customers")
def stg_customers(tables: SalesTables) -> DataFrame:
    return staging.customers(tables)


@query("stg_orders")
def stg_orders(tables: SalesTables) -> DataFrame:
    return staging.orders(tables)


@query("stg_web_events")
def stg_web_events(tables: SalesTables) -> DataFrame:
    return staging.web_events(tables)


@query("stg_ad_spend")
def stg_ad_spend(tables: SalesTables) -> DataFrame:
    return staging.ad_spend(tables)


@query("fct_orders")
def fct_orders(tables: SalesTables) -> DataFrame:
    return staging.fct_orders(tables)


@query("fct_events")
def fct_events(tables: SalesTables) -> DataFrame:
    return staging.fct_events(tables)


# --- marts ------------------------------------------------------------------------------


@query("dim_customer")
def dim_customer(tables: SalesTables) -> DataFrame:
    return marts.dim_customer(tables, AS_OF)


@query("customer_360")
def customer_360(tables: SalesTables) -> DataFrame:
    return _profile(tables)


@query("segment_scores")
def segment_scores(tables: SalesTables) -> DataFrame:
    return marts.segment_scores(tables, AS_OF)


@query("lookback_revenue")
def lookback_revenue(tables: SalesTables) -> DataFrame:
    return marts.lookback_revenue(tables, AS_OF)


@query("first_order")
def first_order(tables: SalesTables) -> DataFrame:
    return marts.first_order(tables)


@query("cohort_retention")
def cohort_retention(tables: SalesTables) -> DataFrame:
    return marts.cohort_retention(tables)


@query("rolling_count")
def rolling_count(tables: SalesTables) -> DataFrame:
    return reports.events_in_window(tables, AS_OF)


@job("materialize_marts")
def materialize_marts(spark: SparkSession, folder: str) -> DataFrame:
    store = warehouse.Folders(spark, scratch_dir(spark, "marts"))
    return warehouse.row_counts(warehouse.build(SalesTables(spark, folder), AS_OF, store))


# --- reports ----------------------------------------------------------------------------


@query("kpi_by_filter")
def kpi_by_filter(tables: SalesTables) -> DataFrame:
    return reports.kpis_by_filter(_profile(tables, *reports.KPI_COLUMNS))


@query("kpi_display")
def kpi_display(tables: SalesTables) -> DataFrame:
    return reports.kpi_display(kpi_by_filter(tables))


@query("hist_revenue")
def hist_revenue(tables: SalesTables) -> DataFrame:
    return reports.revenue_histogram(_profile(tables, "lifetime_revenue"))


@query("hist_nps")
def hist_nps(tables: SalesTables) -> DataFrame:
    return reports.nps_histogram(_profile(tables, "nps_score"))


@query("revenue_by_country")
def revenue_by_country(tables: SalesTables) -> DataFrame:
    return reports.revenue_by_country(_profile(tables, "country", "lifetime_revenue"))


@query("segment_counts")
def segment_counts(tables: SalesTables) -> DataFrame:
    return reports.segment_counts(marts.segment_scores(tables, AS_OF))


@query("segment_performance")
def segment_performance(tables: SalesTables) -> DataFrame:
    return reports.segment_performance(_profile(tables, "lifetime_revenue", *marts.SCORE_INPUTS))


@query("segment_performance_join")
def segment_performance_join(tables: SalesTables) -> DataFrame:
    profile = _profile(tables, "customer_id", "email", "lifetime_revenue", *marts.SCORE_INPUTS)
    return reports.segment_performance_from_marts(marts.segment_scores(tables, AS_OF), profile)


@query("nps_categories")
def nps_categories(tables: SalesTables) -> DataFrame:
    return reports.nps_categories(_profile(tables, "nps_score"))


@query("recent_activity")
def recent_activity(tables: SalesTables) -> DataFrame:
    return reports.recent_activity(_profile(tables, *reports.ACTIVITY_COLUMNS))


@query("top_active")
def top_active(tables: SalesTables) -> DataFrame:
    return reports.top_active_of(tables, AS_OF)


@query("filter_values")
def filter_values(tables: SalesTables) -> DataFrame:
    return reports.filter_values(_profile(tables, "country"), marts.segment_scores(tables, AS_OF))


# --- decisions and payloads -------------------------------------------------------------


@query("segment_context")
def segment_context(tables: SalesTables) -> DataFrame:
    return _records(tables, CHURN_RESCUE)


@query("segment_context_all")
def segment_context_all(tables: SalesTables) -> DataFrame:
    return _records(tables)


@query("segment_context_join")
def segment_context_join(tables: SalesTables) -> DataFrame:
    return marts.segment_records_from_marts(marts.segment_scores(tables, AS_OF), _profile(tables))


@query("first_n_segment")
def first_n_segment(tables: SalesTables) -> DataFrame:
    return marts.best_records(tables, AS_OF, LAPSE_RISK)


@query("next_best_action")
def next_best_action_rows(tables: SalesTables) -> DataFrame:
    action = next_best_action(F.col("segment"), discount_cap=7.0)
    scores = marts.segment_scores(tables, AS_OF)
    return scores.select("customer_id", "segment", action.alias("a")).select("customer_id", "segment", "a.*")


@query("rule_risk")
def rule_risk_rows(tables: SalesTables) -> DataFrame:
    profile = _profile(tables, "customer_id", "nps_score", "events_30d", "lifetime_revenue")
    risk = rule_risk(F.col("nps_score"), F.col("events_30d"), F.col("lifetime_revenue"))
    return profile.select("customer_id", risk.alias("risk"))


@query("template_message")
def template_message_rows(tables: SalesTables) -> DataFrame:
    profile = marts.with_segment(_profile(tables, "customer_id", "first_name", *marts.SCORE_INPUTS))
    message = template_message(F.col("first_name"), next_best_action(F.col("segment")))
    return profile.select("customer_id", message.alias("message"))


@query("activation_payload")
def activation_payload(tables: SalesTables) -> DataFrame:
    return outbox.json_columns(_payload(tables))


@query("nba_flat")
def nba_flat(tables: SalesTables) -> DataFrame:
    return reports.flat_actions(_payload(tables, BRIEF))


@query("risk_display")
def risk_display(tables: SalesTables) -> DataFrame:
    return reports.risk_display(_scored(tables))


@query("messages")
def messages(tables: SalesTables) -> DataFrame:
    message = template_message(F.col("first_name"), F.col("nba_action"))
    # Only records with a discount have a message, so that the filter has rows to drop.
    offered = F.when(F.col("nba_action.discount_pct") > 0, message).otherwise("")
    return reports.messages(_payload(tables, BRIEF).withColumn("personalized_message", offered))


@query("activation_summary")
def activation_summary(tables: SalesTables) -> DataFrame:
    return reports.activation_summary(_payload(tables, BRIEF))


@query("activation_metrics")
def activation_metrics(tables: SalesTables) -> DataFrame:
    return reports.activation_metrics(_scored(tables))


@query("validate_activation")
def validate_activation(tables: SalesTables) -> DataFrame:
    return reports.validate_run(_scored(tables))


@job("payload_roundtrip")
def payload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _payload(SalesTables(spark, folder))
    path = outbox.write_payload(rows, scratch_dir(spark, "outbox"), "all")
    return outbox.read_payload(spark, path, outbox.json_columns(rows).schema)


def _outbox_files(spark: SparkSession, folder: str) -> str:
    """Payload files as other tools leave them: other columns and order, blanks, quotes and line
    ends in values, and one file that is no gzip file although its name says so."""
    work = scratch_dir(spark, "files")
    records = _records(SalesTables(spark, folder), columns=["customer_id", "email", "first_name"])
    rows = records.select(F.col("customer_id").cast("string"), "email", "segment", "first_name")
    padded = rows.filter(F.col("segment") == LAPSE_RISK).withColumn("first_name", F.format_string("  %s ", "first_name"))
    outbox.write_csv(padded, f"{work}/lapse_payload.csv")
    noted = rows.filter(F.col("segment") == CHURN_RESCUE).withColumn("note", F.lit('said "hi",\n bye'))
    outbox.write_csv(noted.select("note", "email", "segment", "customer_id", "first_name"), f"{work}/rescue_payload.csv")
    rows.select("email").write.text(f"{work}/text")
    part = spark.read.text(f"{work}/text").select("_metadata.file_path").first()
    if part is not None:
        files.copy(spark, part[0], f"{work}/damaged_payload.csv.gz")
    return work


@job("payload_files")
def payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two payloads with differing headers, read back by name; the damaged file adds no row."""
    rows = outbox.read_payloads(spark, f"{_outbox_files(spark, folder)}/*_payload.csv*")
    return rows.select("customer_id", "email", "segment", "first_name", "note", "source")


@job("rejected_files")
def rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    bad = outbox.undecodable(spark, f"{_outbox_files(spark, folder)}/*_payload.csv*")
    return bad.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), F.isnotnull("reason").alias("has_reason"))


@job("manual_files")
def manual_files(spark: SparkSession, folder: str) -> DataFrame:
    """Entered records written in two forms, repaired, with the backup of what was read."""
    work = scratch_dir(spark, "manual")
    outbox.append_manual(_entries(SalesTables(spark, folder)), f"{work}/entries.csv")
    manual_entries.repair_file(spark, f"{work}/entries.csv", f"{work}/fixed.csv")
    kept = outbox.read_manual(spark, f"{work}/fixed.csv.bak").withColumn("version", F.lit("backup"))
    return kept.unionByName(outbox.read_manual(spark, f"{work}/fixed.csv").withColumn("version", F.lit("repaired")))


@job("delivered_ledger")
def delivered_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What the ledger holds after a run in which the destination refused some records."""
    work = scratch_dir(spark, "delivered")
    ledger = Ledger(spark, f"{work}/ledger")
    send = delivery.sender(answers.destination(), f"{work}/log")
    activation.deliver(_delivered(SalesTables(spark, folder)), f"{work}/outbox", "all", ledger, dry_run=False, send=send)
    return ledger.rows().select("customer_id", "email", "segment")


# --- model answers, from stand-ins for the external model -----------------------------


@query("model_risk")
def model_risk(tables: SalesTables) -> DataFrame:
    return scoring.model_risk(_records(tables), answers.risk_answers()).select("customer_id", "llm_risk_score")


@query("model_message")
def model_message(tables: SalesTables) -> DataFrame:
    written = scoring.model_message(_payload(tables), answers.message_answers())
    return written.select("customer_id", "personalized_message")


@query("model_sentiment")
def model_sentiment(tables: SalesTables) -> DataFrame:
    scored = scoring.model_sentiment(_records(tables), answers.sentiment_answers())
    insights = F.array_join("key_insights", "; ").alias("key_insights")
    return scored.select("customer_id", "sentiment", insights, "recommended_action")


# --- leads and tasks --------------------------------------------------------------------


@query("lead_rows")
def lead_rows(tables: SalesTables) -> DataFrame:
    return activation.lead_rows(_delivered(tables))


@query("task_rows")
def task_rows(tables: SalesTables) -> DataFrame:
    return activation.task_rows(_delivered(tables))


@query("followup_steps")
def followup_steps(tables: SalesTables) -> DataFrame:
    return activation.follow_ups(_payload(tables, BRIEF))


@query("delivery_log")
def delivery_log(tables: SalesTables) -> DataFrame:
    return delivery.outcomes(_delivered(tables), answers.destination()).drop("error")


# --- hand-entered records ---------------------------------------------------------------


@query("manual_entries")
def manual_entries_rows(tables: SalesTables) -> DataFrame:
    return _entries(tables)


@query("misalign_flag")
def misalign_flag(tables: SalesTables) -> DataFrame:
    return manual_entries.shifted_columns(_entries(tables))


@query("repair_manual")
def repair_manual(tables: SalesTables) -> DataFrame:
    return manual_entries.repaired(_entries(tables))


@query("repair_json")
def repair_json(tables: SalesTables) -> DataFrame:
    return text.repair_json(_entries(tables).select("customer_id", "nba_action"), "nba_action")


@query("normalize_score")
def normalize_score(tables: SalesTables) -> DataFrame:
    return _entries(tables).select("customer_id", unit_score(F.col("score")).alias("score"))


@query("normalize_dates")
def normalize_dates(tables: SalesTables) -> DataFrame:
    days = [parsed_day(F.col(name)).alias(name) for name in ("created_at", "last_event_ts")]
    return _entries(tables).select("customer_id", *days)


@query("manual_activation")
def manual_activation(tables: SalesTables) -> DataFrame:
    return outbox.json_columns(activation.manual_payload(_entries(tables)))


@query("direct_submission")
def direct_submission(tables: SalesTables) -> DataFrame:
    return outbox.json_columns(activation.submission(_entries(tables), AS_OF))


# --- the sent ledger --------------------------------------------------------------------


@query("sent_ledger")
def sent_ledger(tables: SalesTables) -> DataFrame:
    return outreach.sent_records(tables)


@query("sent_keys")
def sent_keys_rows(tables: SalesTables) -> DataFrame:
    return sent_keys.sent_keys(outreach.sent_records(tables))


@query("unsent_by_id")
def unsent_by_id(tables: SalesTables) -> DataFrame:
    return sent_keys.unsent(_entries(tables), outreach.sent_records(tables), "customer_id")


@query("unsent_by_id_email")
def unsent_by_id_email(tables: SalesTables) -> DataFrame:
    return sent_keys.unsent(_entries(tables), outreach.sent_records(tables), "customer_id", "email")


@job("unsent_by_key_index")
def unsent_by_key_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same against a ledger whose first campaign is compacted and whose second is not."""
    tables = SalesTables(spark, folder)
    ledger = Ledger(spark, f"{scratch_dir(spark, 'indexed')}/ledger")
    sent = outreach.sent_records(tables)
    ledger.record(sent.filter("run_id = 'machinery'"), "machinery")
    ledger.compact()
    ledger.record(sent.filter("run_id <> 'machinery'"), "furniture")
    return ledger.unsent(_entries(tables), "customer_id", "email")


@job("payload_ledger")
def payload_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The same where what was sent is known from payload files alone, of which the second came
    after the first was entered."""
    tables, work = SalesTables(spark, folder), scratch_dir(spark, "payloads")
    found = PayloadFiles(Ledger(spark, f"{work}/ledger"), f"{work}/outbox")
    sent = outreach.sent_records(tables).drop("source")
    first = sent.filter("run_id = 'machinery'").select("email", "first_name", "customer_id", "score")
    for name, rows in (("machinery", first), ("furniture", sent.filter("run_id <> 'machinery'"))):
        outbox.write_csv(rows, f"{work}/outbox/{name}_payload.csv")
        found.enter()
    return found.ledger.unsent(_entries(tables), "customer_id", "email")


@query("sent_status")
def sent_status(tables: SalesTables) -> DataFrame:
    marked = sent_keys.mark_sent(_entries(tables), outreach.sent_records(tables))
    return marked.select("customer_id", "email", "first_name", "salesforce_status")


@query("sync_report")
def sync_report(tables: SalesTables) -> DataFrame:
    return sync.sync_report(manual_entries.repaired(_entries(tables)), outreach.sent_records(tables))


@query("ledger_union")
def ledger_union(tables: SalesTables) -> DataFrame:
    return sync.ledger_union(_entries(tables), outreach.sent_records(tables))


@query("ledger_lookup")
def ledger_lookup(tables: SalesTables) -> DataFrame:
    return lookups.shown(ledger_union(tables))


@query("ledger_search")
def ledger_search(tables: SalesTables) -> DataFrame:
    return lookups.shown(lookups.search(ledger_union(tables), "C1"))


@query("record_detail")
def record_detail(tables: SalesTables) -> DataFrame:
    return lookups.shown(lookups.first_per_id(ledger_union(tables), ["source", "email"]))


@query("find_customer")
def find_customer(tables: SalesTables) -> DataFrame:
    found = lookups.find_all(_entries(tables), outreach.lookup_keys(tables))
    return found.select("lookup", "found_by", "customer_id", "email")


@job("stream_sync")
def stream_sync(spark: SparkSession, folder: str) -> DataFrame:
    tables = SalesTables(spark, folder)
    work = scratch_dir(spark, "stream")
    outbox.append_manual(_entries(tables).repartition(4), f"{work}/inbox")
    ledger = Ledger(spark, f"{work}/ledger")
    ledger.record(outreach.sent_records(tables), "before")
    sync_stream.start(spark, f"{work}/inbox", ledger, f"{work}/checkpoint", files_per_batch=2).awaitTermination()
    return ledger.rows(except_run="before").drop("source", "run_id")


# --- data tests -------------------------------------------------------------------------


@query("dq_not_null")
def dq_not_null(tables: SalesTables) -> DataFrame:
    return quality.report(quality_suite.not_null_tests(quality_suite.models(tables, AS_OF)))


@query("dq_unique")
def dq_unique(tables: SalesTables) -> DataFrame:
    return quality.report(quality_suite.unique_tests(quality_suite.models(tables, AS_OF)))


@query("dq_accepted_values")
def dq_accepted_values(tables: SalesTables) -> DataFrame:
    return quality.report(quality_suite.accepted_tests(quality_suite.models(tables, AS_OF)))


@query("dq_report")
def dq_report(tables: SalesTables) -> DataFrame:
    return quality_suite.suite(quality_suite.models(tables, AS_OF))
