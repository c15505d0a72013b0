"""Records scored or written up by an external model.

The prompt is built as a column; only that column goes to Python, in Arrow batches, to a
scorer the caller injects: a function from a list of prompts to a list of answers. Answers
are parsed on the JVM side again, and where an answer is missing or unusable the rules take
over. The package has no model client.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from reachmart.functions.decisions import clamped, discount_number, rule_risk, template_message
from reachmart.functions.text import as_number, filled, float_text, stripped

Scorer = Callable[[Sequence[str]], Sequence[str | None]]

RISK_PROMPT = """Estimate how likely this customer is to leave, from 0.0 (stays) to 1.0 (leaves).

nps_score: {nps_score}
events_30d: {events_30d}
orders_cnt: {orders_cnt}
lifetime_revenue: {lifetime_revenue}
created_at: {created_at}
last_event_ts: {last_event_ts}
country: {country}

Weigh low satisfaction, missing activity, the customer's worth and how new the customer is.
Answer with the number only."""

MESSAGE_PROMPT = """Write the body of a short, warm e-mail (two or three sentences) to this customer.

name: {first_name}
segment: {segment}
nps_score: {nps_score}
lifetime_revenue: {lifetime_revenue}
template: {template}
discount_pct: {discount_pct}

Fit the text to the segment and the template; mention the discount if it is above zero."""

SENTIMENT_PROMPT = """Describe the mood of this customer as JSON with the keys sentiment
(positive, neutral or negative), key_insights (list of texts) and recommended_action (text).

nps_score: {nps_score}
events_30d: {events_30d}
orders_cnt: {orders_cnt}
lifetime_revenue: {lifetime_revenue}
created_at: {created_at}"""

SENTIMENT_TYPE = "struct<sentiment:string,key_insights:array<string>,recommended_action:string>"
# What stands in for a missing analysis.
NO_SENTIMENT = "neutral"
NO_INSIGHTS = ["Analysis unavailable"]
NO_RECOMMENDATION = "Standard follow-up recommended"


def _prompt(template: str, /, **extra: Column) -> Column:
    names = ["nps_score", "events_30d", "orders_cnt", "created_at", "last_event_ts", "country", "first_name", "segment"]
    fields = {name: F.coalesce(F.col(name).cast("string"), F.lit("N/A")) for name in names}
    fields["lifetime_revenue"] = float_text(F.col("lifetime_revenue"))
    return filled(template, **{**fields, **extra})


def ask(prompt: Column, scorer: Scorer) -> Column:
    """The scorer's answer per prompt; null where its call failed.

    Declared non-deterministic, so that no rewrite evaluates a call twice.
    """

    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def call(prompts: list[str]) -> list[str | None]:
            try:
                texts = list(scorer(prompts))
                if len(texts) == len(prompts):
                    return texts
            except Exception:
                pass
            if len(prompts) == 1:
                return [None]
            # One bad record must not cost the others their answer.
            half = len(prompts) // 2
            return call(prompts[:half]) + call(prompts[half:])

        for prompts in batches:
            texts = call(prompts.tolist()) if len(prompts) else []
            yield pd.Series(texts, dtype="object", index=prompts.index)

    return F.pandas_udf(answers, "string").asNondeterministic()(prompt)


def spread(records: DataFrame, tasks: int | None) -> DataFrame:
    """Over so many tasks. Small records end up in few tasks, which suits the data but not a
    slow service; the number also bounds how many callers the service sees."""
    return records if tasks is None else records.repartition(tasks)


def model_risk(records: DataFrame, scorer: Scorer, tasks: int | None = None) -> DataFrame:
    """Adds ``llm_risk_score``: the model's number, cut to [0, 1], else the rule's."""
    asked = spread(records, tasks).withColumn("_answer", ask(_prompt(RISK_PROMPT), scorer))
    rule = rule_risk(F.col("nps_score"), F.col("events_30d"), F.col("lifetime_revenue"))
    risk = F.coalesce(clamped(as_number(F.col("_answer"))), rule)
    return asked.withColumn("llm_risk_score", risk).drop("_answer")


def model_message(records: DataFrame, scorer: Scorer, tasks: int | None = None) -> DataFrame:
    """Adds ``personalized_message``: the model's text, else the template's."""
    action = F.col("nba_action")
    prompt = _prompt(
        MESSAGE_PROMPT,
        template=F.coalesce(action["template"], F.lit("generic")),
        discount_pct=discount_number(action),
    )
    asked = spread(records, tasks).withColumn("_answer", ask(prompt, scorer))
    message = F.coalesce(stripped(F.col("_answer")), template_message(F.col("first_name"), action))
    return asked.withColumn("personalized_message", message).drop("_answer")


def model_sentiment(records: DataFrame, scorer: Scorer, tasks: int | None = None) -> DataFrame:
    """Adds sentiment, key insights and recommendation, with defaults for a failed answer."""
    asked = spread(records, tasks).withColumn("_answer", ask(_prompt(SENTIMENT_PROMPT), scorer))
    parsed = asked.withColumn("_parsed", F.from_json("_answer", SENTIMENT_TYPE))
    good = F.col("_parsed.sentiment").isNotNull()
    return parsed.withColumns(
        {
            "sentiment": F.when(good, F.col("_parsed.sentiment")).otherwise(NO_SENTIMENT),
            "key_insights": F.when(good, F.col("_parsed.key_insights")).otherwise(
                F.array(*[F.lit(text) for text in NO_INSIGHTS])
            ),
            "recommended_action": F.when(good, F.col("_parsed.recommended_action")).otherwise(NO_RECOMMENDATION),
        }
    ).drop("_answer", "_parsed")
