"""From records to payloads, leads and tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reachmart.functions.cleaning import derived_id
from reachmart.functions.decisions import (
    ACTION_TYPE, CHURN_RESCUE, FIRST_WEEK_INTENT, LAPSE_RISK, LEAD_SEGMENTS, by_value, follow_up_steps,
    next_best_action, rule_risk,
)
from reachmart.functions.temporal import Instant, as_datetime
from reachmart.functions.text import (
    capitalized, filled, float_text, has_at, is_json, is_number_text, local_part, or_default,
)
from reachmart.operators import lookups
from reachmart.plans.scoring import Scorer, model_message, model_risk, spread
from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger

# Texts of leads and tasks.
LEAD_SOURCE = "Customer Activation Platform"
LEAD_STATUS = "Open - Not Contacted"
LEAD_TITLE = "Customer"
NO_NAME, NO_EMAIL, NO_ID = "Unknown", "no-email", "unknown"
TASK_STATUS = "Not Started"
TASK_PRIORITY = "High"
SUBJECTS = {
    LAPSE_RISK: "High-value customer at risk - Immediate follow-up",
    FIRST_WEEK_INTENT: "New user onboarding - Follow up on initial experience",
    CHURN_RESCUE: "Customer satisfaction issue - Urgent outreach needed",
}
DEFAULT_SUBJECT = "Follow up on {template} campaign"
DESCRIPTION = "Follow up with {name} regarding {template}. Customer score: {score}. Segment: {segment}."


def payload(
    records: DataFrame,
    discount_cap: float = 10.0,
    risk_scorer: Scorer | None = None,
    message_scorer: Scorer | None = None,
    goal: str = "90d_clv",
    suppress_hours: int = 48,
    model_tasks: int | None = None,
) -> DataFrame:
    """Records with their action and, if there is a model, risk and message."""
    action = next_best_action(F.col("segment"), discount_cap, goal, suppress_hours)
    result = records.withColumn("nba_action", action)
    if risk_scorer is not None or message_scorer is not None:
        result = spread(result, model_tasks)
    if risk_scorer is not None:
        result = model_risk(result, risk_scorer)
    if message_scorer is not None:
        result = model_message(result, message_scorer)
    return result


def manual_payload(entries: DataFrame, key: str | None = None, discount_cap: float = 10.0, **scorers) -> DataFrame:
    """The payload of hand-entered records: all, or those one key finds. The action a record
    came with is replaced by the one of its segment; ``scorers`` as for ``payload``."""
    chosen = entries if key is None else lookups.find_entries(entries, key)
    return payload(chosen, discount_cap, **scorers)


def deliver(
    result: DataFrame,
    outbox_dir: str,
    name: str,
    ledger: Ledger,
    dry_run: bool = True,
    send: Callable[[DataFrame], DataFrame | None] | None = None,
    run_id: str | None = None,
    count_dry_runs: bool = False,
) -> str:
    """Writes the payload, hands its records to ``send``, then enters them into the ledger.

    The payload ``name`` is replaced by each run; the ledger keeps one entry per ``run_id``.
    Records are also written as Parquet, and everything after that starts from there, so a
    model is asked once per record. If ``send`` returns outcomes, as ``delivery.sender``
    does, only records whose lead and task were created enter the ledger; all others stay
    pending. A dry run ends with the payload, unless ``count_dry_runs`` has its records
    count as sent.
    """
    written = outbox.hand_off(result, outbox_dir, name)
    path = outbox.write_payload(written.drop("_record"), outbox_dir, name)
    done = written
    if send is not None and not dry_run:
        results = send(written)
        if results is not None:
            done = delivered(written, results)
    if count_dry_runs or not dry_run:
        ledger.record(done.drop("_record"), run_id or name)
    return path


def delivered(records: DataFrame, results: DataFrame) -> DataFrame:
    """The numbered records whose lead and task were both created."""
    done = results.filter("task_created").select("_record").distinct()
    return records.join(done, "_record", "left_semi")


def submission(
    entries: DataFrame, sent_at: Instant, risk_scorer: Scorer | None = None, message_scorer: Scorer | None = None
) -> DataFrame:
    """Freshly submitted entries made ready to send: action parsed, time of sending, risk and,
    with a model, message; the required fields of a lead are filled in."""
    numbers = {name: F.col(name).try_cast(kind) for name, kind in NUMBERS.items()}
    typed = entries.withColumns({**numbers, "nba_action": action_of(entries)})
    risk = rule_risk(F.col("nps_score"), F.col("events_30d"), F.col("lifetime_revenue"))
    scored = typed.withColumn("llm_risk_score", risk) if risk_scorer is None else model_risk(typed, risk_scorer)
    if message_scorer is not None:
        scored = model_message(scored, message_scorer)
    name = or_default(F.col("first_name"), MISSING_NAME)
    return scored.withColumns(
        {
            "_sent_to_salesforce_at": F.lit(as_datetime(sent_at).strftime("%Y-%m-%d %H:%M:%S")),
            "email": or_default(F.col("email"), MISSING_EMAIL),
            "company": or_default(F.col("company"), filled("{name} Company", name=name)),
            "first_name": name,
        }
    )


NUMBERS = {"nps_score": "int", "events_30d": "bigint", "orders_cnt": "bigint", "lifetime_revenue": "double"}
# What stands in for a missing name or e-mail.
MISSING_NAME = "Customer"
MISSING_EMAIL = "customer@example.com"


def first_of_segment(records: DataFrame, n: int = 2) -> DataFrame:
    """The report's first records: highest scores first."""
    return records.orderBy(F.desc("score"), "customer_id").limit(n)


# --- leads and tasks --------------------------------------------------------------------


def _with_lead_fields(records: DataFrame) -> DataFrame:
    """Id, name and e-mail after the swaps, in three steps that build on each other."""
    name, email, key = F.col("_name"), F.col("_email"), F.col("_id")
    start = records.withColumns(
        {
            "_name": _given(records, "first_name", NO_NAME),
            "_email": _given(records, "email", NO_EMAIL),
            "_id": _given(records, "customer_id", NO_ID),
        }
    )
    exchanged = has_at(name) & ~has_at(email)
    swapped = start.withColumns(
        {"_name": F.when(exchanged, email).otherwise(name), "_email": F.when(exchanged, name).otherwise(email)}
    )
    id_is_email = has_at(key) & ~has_at(email)
    moved = swapped.withColumns(
        {
            "_email": F.when(id_is_email, key).otherwise(email),
            "_id": F.when(id_is_email & ~key.startswith("manual-"), derived_id(key)).otherwise(key),
        }
    )
    missing = key.isNull() | key.isin("", NO_ID)
    return moved.withColumns(
        {
            "_id": F.when(missing, derived_id(email)).otherwise(key),
            "_name": F.when(is_number_text(name) & has_at(email), capitalized(local_part(email))).otherwise(name),
        }
    )


def _given(records: DataFrame, column: str, default: str) -> Column:
    """A column as text; the default only where the records have no such column."""
    return F.col(column).cast("string") if column in records.columns else F.lit(default)


def _optional(records: DataFrame, column: str, default: Column) -> Column:
    return F.coalesce(F.col(column), default) if column in records.columns else default


def _is_lead() -> Column:
    return F.col("segment").isin(LEAD_SEGMENTS)


def lead_reference(key: Column) -> Column:
    """The id a lead goes by until the destination gave it one."""
    return F.concat(F.lit("SF-"), key)


def _lead(records: DataFrame) -> dict[str, Column]:
    name = F.col("_name")
    return {
        "FirstName": name,
        "LastName": _optional(records, "last_name", name),
        "Email": F.col("_email"),
        "Company": _optional(records, "company", filled("{name} Company", name=name)),
        "Title": _optional(records, "title", F.lit(LEAD_TITLE)),
        "LeadSource": F.lit(LEAD_SOURCE),
        "Status": F.lit(LEAD_STATUS),
    }


def _task(records: DataFrame) -> dict[str, Column]:
    """The task's name is the entered one, or for a number the e-mail's."""
    entered, email = _given(records, "first_name", NO_NAME), _given(records, "email", NO_EMAIL)
    segment = F.col("segment")
    from_email = F.when(has_at(email), capitalized(local_part(email))).otherwise("Customer")
    name = F.when(is_number_text(entered), from_email).otherwise(entered)
    template = F.coalesce(action_of(records)["template"], F.lit("general"))
    subjects = {key: F.lit(text) for key, text in SUBJECTS.items()}
    score = F.lit("N/A")
    if "score" in records.columns:
        score = F.coalesce(float_text(F.col("score").try_cast("double")), score)
    return {
        "Subject": by_value(segment, subjects, filled(DEFAULT_SUBJECT, template=template)),
        "WhoId": lead_reference(F.col("_id")),
        "Status": F.lit(TASK_STATUS),
        "Priority": F.lit(TASK_PRIORITY),
        "Description": filled(DESCRIPTION, name=name, template=template, score=score, segment=segment),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def lead_rows(records: DataFrame) -> DataFrame:
    """One lead per record of a target segment."""
    fixed = _with_lead_fields(records.filter(_is_lead()))
    return fixed.select(F.col("_id").alias("customer_id"), *_named(_lead(records)))


def task_rows(records: DataFrame) -> DataFrame:
    """One task per lead."""
    fixed = _with_lead_fields(records.filter(_is_lead()))
    return fixed.select(F.col("_id").alias("customer_id"), *_named(_task(records)))


def outreach_rows(records: DataFrame, carried: list[str] = []) -> DataFrame:
    """Lead and task of a record side by side, with the ``carried`` columns: a task needs the
    id of its lead, and two records of one customer must not be mixed up by a join."""
    fixed = _with_lead_fields(records.filter(_is_lead()))
    lead, task = F.struct(*_named(_lead(records))), F.struct(*_named(_task(records)))
    return fixed.select(F.col("_id").alias("customer_id"), lead.alias("lead"), task.alias("task"), *carried)


def action_of(records: DataFrame) -> Column:
    """The action as a struct, also where a file gave it as JSON text; null for other text."""
    if "nba_action" not in records.columns:
        return F.lit(None).cast(ACTION_TYPE)
    action = F.col("nba_action")
    if dict(records.dtypes)["nba_action"] != "string":
        return action
    return F.when(is_json(action), F.from_json(action, ACTION_TYPE))


def follow_ups(result: DataFrame) -> DataFrame:
    """What the destination does for each record, step by step."""
    steps = follow_up_steps(F.col("segment"), action_of(result)["template"])
    return result.select("customer_id", "segment", F.array_join(steps, "; ").alias("steps"))
