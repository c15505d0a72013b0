"""Segment, score, next best action, risk and message as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reachmart.functions.text import filled, float_text

# Segment names, thresholds, actions, texts.
LAPSE_RISK = "high_value_lapse_risk"
FIRST_WEEK_INTENT = "new_users_first_week_intent"
CHURN_RESCUE = "churn_rescue_nps"
UNCLASSIFIED = "unclassified"
TARGET_SEGMENTS = [LAPSE_RISK, FIRST_WEEK_INTENT, CHURN_RESCUE]
ALL_SEGMENTS = [*TARGET_SEGMENTS, UNCLASSIFIED]
LEAD_SEGMENTS = ["high_value", "at_risk", *TARGET_SEGMENTS]

HIGH_VALUE_REVENUE = 150
INTENT_EVENTS = 2
HAPPY_NPS = 7

ACTIONS = {  # segment: channel, template, discount before the cap
    LAPSE_RISK: ("email", "winback_soft", 5.0),
    FIRST_WEEK_INTENT: ("email", "onboarding_tips", 0.0),
    CHURN_RESCUE: ("cs_ticket", "nps_followup_then_offer", 10.0),
}
NO_ACTION = ("none", "holdout", 0.0)

MESSAGES = {
    "winback_soft": "Hi {name}, we miss you! Here's {discount}% off your next order to welcome you back.",
    "onboarding_tips": "Welcome {name}! Here are some tips to get the most out of your experience with us.",
    "nps_followup_then_offer": (
        "Hi {name}, thanks for your feedback. Let's make this right with a {discount}% discount on us."
    ),
}
DEFAULT_MESSAGE = "Hi {name}, we have something special for you!"
DEFAULT_NAME = "valued customer"

FOLLOW_UPS = {
    LAPSE_RISK: ["Created high-priority opportunity", "Assigned to account manager"],
    CHURN_RESCUE: ["Created support case for follow-up", "Triggered customer success workflow"],
}
DEFAULT_FOLLOW_UP = ["Updated lead score and priority"]

ACTION_TYPE = "struct<channel:string,template:string,discount_pct:double>"


def by_value(key: Column, choices: dict[str, Column], otherwise: Column) -> Column:
    """A CASE over the fixed values of one column."""
    branch = F
    for value, result in choices.items():
        branch = branch.when(key == value, result)
    return branch.otherwise(otherwise)


def is_unhappy(nps: Column) -> Column:
    """A missing answer is not an unhappy one."""
    return F.coalesce(nps < HAPPY_NPS, F.lit(False))


def segment_name(revenue_90d: Column, events_30d: Column, nps: Column) -> Column:
    return (
        F.when((revenue_90d >= HIGH_VALUE_REVENUE) & (events_30d == 0), LAPSE_RISK)
        .when((revenue_90d == 0) & (events_30d >= INTENT_EVENTS), FIRST_WEEK_INTENT)
        .when(is_unhappy(nps), CHURN_RESCUE)
        .otherwise(UNCLASSIFIED)
    )


def segment_score(revenue_90d: Column, events_30d: Column, nps: Column) -> Column:
    return revenue_90d * 0.6 + events_30d * 5 + F.when(is_unhappy(nps), 20).otherwise(0)


def next_best_action(
    segment: Column, discount_cap: float = 10.0, goal: str = "90d_clv", suppress_hours: int = 48
) -> Column:
    """The action struct. ``goal`` and ``suppress_hours`` belong to the signature but no rule
    uses them."""

    def action(channel: str, template: str, discount: float) -> Column:
        return F.struct(
            F.lit(channel).alias("channel"),
            F.lit(template).alias("template"),
            F.lit(min(discount, float(discount_cap)) if discount else 0.0).alias("discount_pct"),
        )

    return by_value(segment, {name: action(*rule) for name, rule in ACTIONS.items()}, action(*NO_ACTION))


def rule_risk(nps: Column, events_30d: Column, lifetime_revenue: Column) -> Column:
    """Churn risk in [0, 1]; unknown where the NPS answer is missing."""
    mood = F.greatest(F.lit(0.0), (F.lit(7) - nps) / 7)
    activity = F.when(F.coalesce(events_30d, F.lit(0)) == 0, 1.0).otherwise(0.3)
    worth = F.least(F.lit(1.0), F.coalesce(lifetime_revenue, F.lit(0.0)) / 500)
    return F.when(nps.isNotNull(), clamped((mood * 0.4 + activity * 0.6) * worth))


def clamped(value: Column) -> Column:
    """Into [0, 1]; null stays null, which ``least`` and ``greatest`` would hide."""
    return F.when(value.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))


def template_message(first_name: Column, action: Column) -> Column:
    name = F.coalesce(first_name, F.lit(DEFAULT_NAME))
    discount = discount_number(action)
    texts = {key: filled(text, name=name, discount=discount) for key, text in MESSAGES.items()}
    return by_value(action["template"], texts, filled(DEFAULT_MESSAGE, name=name))


def nps_class(nps: Column) -> Column:
    """A missing answer falls through to the last class."""
    return F.when(nps >= 9, "Promoters").when(nps >= HAPPY_NPS, "Passives").otherwise("Detractors")


def follow_up_steps(segment: Column, template: Column) -> Column:
    def steps(texts: list[str]) -> Column:
        task = filled("Created task: Follow up on {template}", template=F.coalesce(template, F.lit("activation")))
        return F.array(*[F.lit(text) for text in texts], task)

    return by_value(segment, {name: steps(texts) for name, texts in FOLLOW_UPS.items()}, steps(DEFAULT_FOLLOW_UP))


def discount_number(action: Column) -> Column:
    """The discount as text, with its decimal; an action without one prints a bare zero."""
    return F.coalesce(float_text(action["discount_pct"]), F.lit("0"))


def discount_text(action: Column) -> Column:
    return F.concat(discount_number(action), F.lit("%"))
