"""Decision columns against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from reachmart.functions import decisions, text
from reachmart.plans import scoring


def test_segments_and_scores(column):
    rows = [(0.0, 2, None), (150.0, 0, 3), (149.99, 0, None), (0.0, 1, 6), (10.0, 5, 7), (0.0, 0, 0)]
    schema = "r double, e bigint, n int"
    names = column(rows, schema, decisions.segment_name(F.col("r"), F.col("e"), F.col("n")))
    assert names == [
        "new_users_first_week_intent", "high_value_lapse_risk", "unclassified", "churn_rescue_nps", "unclassified",
        "churn_rescue_nps",
    ]
    scores = column(rows, schema, decisions.segment_score(F.col("r"), F.col("e"), F.col("n")))
    assert scores == pytest.approx([10.0, 110.0, 89.994, 25.0, 31.0, 20.0])


def test_next_best_action(column):
    names = [(name,) for name in [*decisions.ALL_SEGMENTS, "something else", None]]
    got = column(names, "s string", decisions.next_best_action(F.col("s"), discount_cap=7))
    assert [tuple(row) for row in got] == [
        ("email", "winback_soft", 5.0),
        ("email", "onboarding_tips", 0.0),
        ("cs_ticket", "nps_followup_then_offer", 7.0),
        ("none", "holdout", 0.0),
        ("none", "holdout", 0.0),
        ("none", "holdout", 0.0),
    ]
    low = column([("high_value_lapse_risk",)], "s string", decisions.next_best_action(F.col("s"), 2.5))
    assert low[0]["discount_pct"] == 2.5


def test_rule_risk(column):
    def expected(nps, events, revenue):
        if nps is None:
            return None
        mood = max(0, (7 - nps) / 7)
        value = (mood * 0.4 + (1.0 if events == 0 else 0.3) * 0.6) * min(1.0, revenue / 500)
        return min(1.0, max(0.0, value))

    draw = random.Random(1)
    rows = [(draw.choice([None, *range(11)]), draw.randrange(3), draw.randrange(90000) / 100) for _ in range(500)]
    rows += [(3, 0, 500.0), (0, 0, 1e9), (10, 0, -5.0)]
    got = column(rows, "n int, e bigint, r double", decisions.rule_risk(F.col("n"), F.col("e"), F.col("r")))
    assert got == [expected(*row) for row in rows]
    assert got[-3] == pytest.approx(0.8285714285714286)


def test_template_messages(column):
    rows = [("Ann", "winback_soft", 5.0), (None, "onboarding_tips", 0.0), ("Bo", "nps_followup_then_offer", 7.5),
            ("Cy", "holdout", 0.0), ("Di", None, None), ("Ed", "winback_soft", None)]
    action = F.struct(F.col("t").alias("template"), F.col("d").alias("discount_pct"))
    got = column(rows, "n string, t string, d double", decisions.template_message(F.col("n"), action))
    assert got == [
        "Hi Ann, we miss you! Here's 5.0% off your next order to welcome you back.",
        "Welcome valued customer! Here are some tips to get the most out of your experience with us.",
        "Hi Bo, thanks for your feedback. Let's make this right with a 7.5% discount on us.",
        "Hi Cy, we have something special for you!",
        "Hi Di, we have something special for you!",
        "Hi Ed, we miss you! Here's 0% off your next order to welcome you back.",
    ]
    shown = column(rows, "n string, t string, d double", decisions.discount_text(action))
    assert shown == ["5.0%", "0.0%", "7.5%", "0.0%", "0%", "0%"]


def test_nps_classes(column):
    got = column([(10,), (9,), (8,), (7,), (6,), (None,)], "n int", decisions.nps_class(F.col("n")))
    assert got == ["Promoters", "Promoters", "Passives", "Passives", "Detractors", "Detractors"]


def test_float_text(column):
    draw = random.Random(2)
    values = [0.0, -0.0, 1.0, 118.0, 0.1, 12345678.9, 1e7, 9999999.999, 1e15, 123456789012345.6, 1e16, 1.5e300, 6e-05,
              0.0001, 0.00012345, 1.25e-7, -12345678.5, 0.001, 0.0009999]
    values += [draw.uniform(-1, 1) * 10 ** draw.randrange(-8, 20) for _ in range(2000)]
    values += [draw.randrange(10**9) / 100 for _ in range(500)]
    got = column([(v,) for v in values], "x double", text.float_text(F.col("x")))
    assert [float(g) for g in got] == values
    # From 1e16 on the JVM may print a digit more than needed; the number is the same.
    assert [g for g, v in zip(got, values) if abs(v) < 1e16] == [repr(v) for v in values if abs(v) < 1e16]


@pytest.mark.parametrize("places", [0, 1, 3])
def test_fixed_text(column, places):
    draw = random.Random(3)
    values = [0.0, 0.1235, 0.0625, 0.1875, 0.0005, 0.0015, 0.9995, 1.0, 7.25, 6.85, 0.5, 1.5, 2.5]
    values += [k / 2000 for k in range(2001)] + [draw.random() for _ in range(2000)]
    got = column([(v,) for v in values], "x double", text.fixed_text(F.col("x"), places))
    assert got == [f"{v:.{places}f}" for v in values]


def test_follow_ups(column):
    got = column([("churn_rescue_nps", "x"), ("other", None)], "s string, t string",
                 decisions.follow_up_steps(F.col("s"), F.col("t")))
    assert got == [
        ["Created support case for follow-up", "Triggered customer success workflow", "Created task: Follow up on x"],
        ["Updated lead score and priority", "Created task: Follow up on activation"],
    ]


RECORD = (
    "customer_id int, first_name string, segment string, nps_score int, events_30d bigint, orders_cnt bigint, "
    "lifetime_revenue double, created_at string, last_event_ts string, country string"
)


def records(spark, n):
    rows = [(i, f"N{i}", "churn_rescue_nps", i % 11, i % 3, 1, 250.0, "2024-01-01", "N/A", "US") for i in range(n)]
    return spark.createDataFrame(rows, RECORD)


def failing_scorer():
    def scorer(prompts):
        raise TimeoutError("no answer")

    return scorer


def picky_scorer():
    def scorer(prompts):
        if any("nps_score: 4" in prompt for prompt in prompts):
            raise ValueError("one bad record")
        return ["0.5"] * len(prompts)

    return scorer


def test_failed_model_falls_back_to_rules(spark):
    frame = records(spark, 30)
    rule = decisions.rule_risk(F.col("nps_score"), F.col("events_30d"), F.col("lifetime_revenue"))
    expected = [row[0] for row in frame.orderBy("customer_id").select(rule).collect()]
    scored = scoring.model_risk(frame, failing_scorer()).orderBy("customer_id").collect()
    assert [row["llm_risk_score"] for row in scored] == expected


def test_one_bad_record_costs_only_itself(spark):
    scored = scoring.model_risk(records(spark, 40), picky_scorer()).collect()
    assert {row["nps_score"] for row in scored if row["llm_risk_score"] != 0.5} == {4}


def test_sentiment_defaults(spark):
    row = scoring.model_sentiment(records(spark, 1), failing_scorer()).collect()[0]
    assert (row["sentiment"], row["key_insights"], row["recommended_action"]) == (
        "neutral", ["Analysis unavailable"], "Standard follow-up recommended",
    )


def test_message_falls_back_to_template(spark):
    frame = records(spark, 1).withColumn("nba_action", decisions.next_best_action(F.col("segment")))
    row = scoring.model_message(frame, failing_scorer()).collect()[0]
    assert row["personalized_message"].startswith("Hi N0, thanks for your feedback.")


def test_calls_are_spread(spark):
    frame = records(spark, 40).coalesce(1)
    scored = scoring.model_message(
        frame.withColumn("nba_action", decisions.next_best_action(F.col("segment"))), picky_scorer(), tasks=4
    )
    sizes = [row["count"] for row in scored.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 40
