"""Marts and reports against plain loops, on random tables with gaps of every kind."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reachmart.operators import activity
from reachmart.plans import marts, quality_suite, reports, staging

AS_OF = datetime(2024, 3, 31)


class RandomTables:
    """Unknown and missing customers, missing times, amounts, states and answers; one
    customer owns a third of the facts."""

    def __init__(self, spark, seed):
        draw = random.Random(seed)

        def maybe(value, chance=0.1):
            return None if draw.random() < chance else value

        def customer():
            return 1 if draw.random() < 1 / 3 else maybe(draw.randrange(130))

        def moment(days):
            near = draw.choice([0, 30, 84, 90]) * 86_400
            return AS_OF - timedelta(seconds=draw.choice([near, near + 1, draw.randrange(-5 * 86_400, days * 86_400)]))

        self.customer_rows = [
            (k, f"User{k}@X.com", maybe(f"N{k}"), f"L{k}", date(2020, 1, 1), maybe(draw.choice(["US", "CA", ""])),
             maybe(draw.randrange(2)), maybe(draw.randrange(21) / 2, 0.2))
            for k in range(100)
        ]
        self.order_rows = [
            (k, customer(), maybe(moment(400), 0.05), draw.choice(["paid", "paid", "refunded", None]),
             maybe(draw.randrange(-500, 9000) / 100))
            for k in range(800)
        ]
        self.event_rows = [(k, customer(), "view", maybe(moment(60), 0.05), f"s{k}") for k in range(600)]
        self.frames = {
            "customers": spark.createDataFrame(
                self.customer_rows,
                "customer_id bigint, email string, first_name string, last_name string, created_at date, "
                "country string, marketing_opt_in int, nps_score double",
            ),
            "orders": spark.createDataFrame(
                self.order_rows,
                "order_id bigint, customer_id bigint, order_ts timestamp_ntz, status string, amount double",
            ),
            "web_events": spark.createDataFrame(
                self.event_rows,
                "event_id bigint, customer_id bigint, event_type string, event_ts timestamp_ntz, session_id string",
            ),
        }

    def customers(self, columns=None):
        return self.frames["customers"]

    def orders(self, since=None):
        return self.frames["orders"]  # a source may ignore the bound

    def web_events(self, since=None):
        return self.frames["web_events"]


def total(amounts):
    return float(sum(Decimal(str(a)) for a in amounts if a is not None))


def expected_profile(tables):
    orders, events = defaultdict(list), defaultdict(list)
    for row in tables.order_rows:
        orders[row[1]].append(row)
    for row in tables.event_rows:
        events[row[1]].append(row)

    def recent(ts, days):
        return ts is not None and ts >= AS_OF - timedelta(days=days)

    profile = {}
    for key, email, first, last, created, country, opt_in, nps in tables.customer_rows:
        paid = [row for row in orders[key] if row[3] == "paid"]
        seen = [row[3] for row in events[key] if row[3] is not None]
        profile[key] = (
            key, email.lower(), first, last, created, country, opt_in or 0, None if nps is None else round(nps),
            len(orders[key]), total(r[4] for r in paid), max(seen, default=None),
            total(r[4] for r in paid if recent(r[2], 84)), total(r[4] for r in paid if recent(r[2], 90)),
            sum(recent(ts, 30) for ts in seen),
        )
    return profile


def expected_segment(revenue, events, nps):
    unhappy = nps is not None and nps < 7
    if revenue >= 150 and events == 0:
        name = "high_value_lapse_risk"
    elif revenue == 0 and events >= 2:
        name = "new_users_first_week_intent"
    else:
        name = "churn_rescue_nps" if unhappy else "unclassified"
    return name, revenue * 0.6 + events * 5 + (20 if unhappy else 0)


@pytest.fixture(scope="module", params=[1, 2, 3])
def tables(spark, request):
    return RandomTables(spark, request.param)


def test_profile(tables):
    rows = {row["customer_id"]: tuple(row) for row in marts.customer_360(tables, AS_OF).collect()}
    assert rows == expected_profile(tables)


def test_scores_and_records(tables):
    profile = expected_profile(tables)
    expected = {k: (row[1], *expected_segment(row[12], row[13], row[7])) for k, row in profile.items()}
    assert {r[0]: tuple(r)[1:] for r in marts.segment_scores(tables, AS_OF).collect()} == expected
    records = marts.segment_records(marts.customer_360(tables, AS_OF)).collect()
    assert {r["customer_id"] for r in records} == {k for k, row in expected.items() if row[1] != "unclassified"}
    for record in records:
        row = profile[record["customer_id"]]
        assert (record["first_name"], record["country"], record["last_event_ts"]) == (
            row[2] or "valued customer", row[5] or "Unknown", str(row[10]) if row[10] else "N/A",
        )
    counts = Counter(row[1] for row in expected.values())
    found = {r["segment"]: r["customers"] for r in reports.segment_counts(marts.segment_scores(tables, AS_OF)).collect()}
    assert found == counts and sum(found.values()) == len(profile)  # segments split the customers


def test_cohorts_and_first_orders(tables):
    def week(ts):
        return ts and datetime.combine(ts.date() - timedelta(days=ts.weekday()), datetime.min.time())

    paid = defaultdict(list)
    for _, customer, ts, status, _ in tables.order_rows:
        if status == "paid":
            paid[customer].append(ts)
    first = {k: min((ts for ts in moments if ts), default=None) for k, moments in paid.items()}
    expected = Counter()
    for customer, moments in paid.items():
        if customer is not None:
            expected.update({(week(first[customer]), week(ts)): 1 for ts in moments}.keys())
    found = {(r[0], r[1]): r[2] for r in marts.cohort_retention(tables).collect()}
    assert found == expected
    assert {tuple(r) for r in marts.first_order(tables).collect()} == set(first.items())


def test_reports(tables):
    profile = expected_profile(tables)
    frame = marts.customer_360(tables, AS_OF)
    for country in ("All", "US", "CA"):
        rows = [row for row in profile.values() if country in ("All", row[5])]
        answers = [row[7] for row in rows if row[7] is not None]
        assert tuple(reports.kpis(frame, country).collect()[0]) == (
            len(rows), total(row[9] for row in rows), sum(answers) / len(answers), sum(row[13] > 0 for row in rows),
        )
    by_country = defaultdict(list)
    for row in profile.values():
        if row[5] is not None:
            by_country[row[5]].append(row[9])
    found = {r["country"]: r["lifetime_revenue"] for r in reports.revenue_by_country(frame).collect()}
    assert found == {country: total(amounts) for country, amounts in by_country.items()}
    values = [row[9] for row in profile.values()]
    low, width = min(values), (max(values) - min(values)) / 20
    bins = Counter(min(int((value - low) // width), 19) for value in values)
    found = {r["bin"]: r["customers"] for r in reports.revenue_histogram(frame).collect()}
    assert sum(found.values()) == len(values) and set(found) <= set(range(20))
    assert sum(abs(found.get(b, 0) - bins.get(b, 0)) for b in range(20)) == 0


def test_counts_and_data_tests(tables):
    stamps = [row[3] for row in tables.event_rows]
    row = staging.web_events(tables).agg(activity.rolling_count(F.col("event_ts"), AS_OF, 7)).collect()[0]
    assert row[0] == sum(ts is not None and ts >= AS_OF - timedelta(days=7) for ts in stamps)
    empty = staging.web_events(tables).limit(0)
    assert empty.agg(activity.rolling_count(F.col("event_ts"), AS_OF)).collect()[0][0] is None
    results = quality_suite.suite(quality_suite.models(tables, AS_OF)).collect()
    assert len(results) == 9 and all(r["passed"] for r in results)  # a missing state passes
