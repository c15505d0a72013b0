"""Marts on the seeds, with results worked out by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reachmart.plans import marts, quality_suite, reports, staging, warehouse
from reachmart.sources.tables import SeedTables, WarehouseTables

UNCLASSIFIED, RESCUE, LAPSE = "unclassified", "churn_rescue_nps", "high_value_lapse_risk"
INTENT = "new_users_first_week_intent"

EXPECTED = {  # as_of: {customer: (revenue_12wk, revenue_90d, events_30d, segment, score)}
    "2024-06-30": {
        10: (160.2, 160.2, 1, UNCLASSIFIED, 101.12),
        11: (0.0, 33.3, 1, RESCUE, 44.98),
        12: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
        13: (0.0, 0.0, 1, RESCUE, 25.0),
        14: (175.5, 175.5, 0, LAPSE, 105.3),
        15: (0.0, 0.0, 2, INTENT, 10.0),
    },
    "2024-08-01": {
        10: (70.0, 160.2, 0, LAPSE, 96.12),
        11: (0.0, 0.0, 0, RESCUE, 20.0),
        12: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
        13: (0.0, 0.0, 0, RESCUE, 20.0),
        14: (175.5, 175.5, 0, LAPSE, 105.3),
        15: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
    },
    "2025-07-01": {
        10: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
        11: (0.0, 0.0, 0, RESCUE, 20.0),
        12: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
        13: (0.0, 0.0, 0, RESCUE, 20.0),
        14: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
        15: (0.0, 0.0, 0, UNCLASSIFIED, 0.0),
    },
}


@pytest.fixture(scope="module")
def tables(spark, seed_folder):
    return SeedTables(spark, seed_folder)


@pytest.mark.parametrize("as_of", EXPECTED)
def test_profile_and_scores(tables, as_of):
    profile = {row["customer_id"]: row for row in marts.customer_360(tables, as_of).collect()}
    scores = {row["customer_id"]: row for row in marts.segment_scores(tables, as_of).collect()}
    got = {
        key: (
            row["revenue_12wk"],
            row["revenue_90d"],
            row["events_30d"],
            scores[key]["segment"],
            pytest.approx(scores[key]["score"]),
        )
        for key, row in profile.items()
    }
    assert got == EXPECTED[as_of]


def test_dimension(tables):
    rows = {row["customer_id"]: row for row in marts.dim_customer(tables, "2024-06-30").collect()}
    assert rows[10]["email"] == "mia@shop.example"
    assert rows[11]["marketing_opt_in"] == 0 and rows[12]["nps_score"] is None
    assert rows[12]["orders_cnt"] == 0 and rows[12]["last_event_ts"] is None
    assert (rows[13]["orders_cnt"], rows[13]["lifetime_revenue"]) == (1, 0.0)  # only refunded
    assert rows[15]["last_event_ts"] == datetime(2024, 6, 27, 10, 5)
    assert rows[14]["created_at"] == date(2024, 6, 1)


def test_cohorts(tables):
    rows = marts.cohort_retention(tables).collect()
    assert sorted((r[0].date().isoformat(), r[1].date().isoformat(), r[2]) for r in rows) == [
        ("2024-04-01", "2024-04-01", 1),
        ("2024-05-06", "2024-05-06", 1),
        ("2024-05-06", "2024-06-10", 1),
        ("2024-06-10", "2024-06-10", 1),
        ("2024-06-10", "2024-06-17", 1),
    ]


def test_cohorts_brute_force(spark):
    """Repeated weeks, refunds, missing customers and times."""
    rows = [
        (1, "2024-01-01 00:00:00", "paid"), (1, "2024-01-07 23:59:59", "paid"), (1, "2024-01-08 00:00:00", "paid"),
        (2, "2024-01-10 10:00:00", "paid"), (2, "2023-12-31 10:00:00", "refunded"), (2, None, "paid"),
        (3, "2024-01-03 10:00:00", "refunded"), (None, "2024-01-03 10:00:00", "paid"), (4, None, "paid"),
        (5, "2024-01-02 00:00:00", "paid"), (5, "2024-01-02 00:00:01", "paid"),
    ]
    frame = spark.createDataFrame(rows, "customer_id bigint, ts string, status string")
    frame = frame.withColumn("order_ts", F.col("ts").cast("timestamp_ntz"))
    from reachmart.operators.activity import weekly_cohorts

    def day(value):
        return value and value.date().isoformat()

    got = {(day(r[0]), day(r[1]), r[2]) for r in weekly_cohorts(frame).collect()}
    assert got == {
        ("2024-01-01", "2024-01-01", 2),
        ("2024-01-01", "2024-01-08", 1),
        ("2024-01-08", "2024-01-08", 1),
        ("2024-01-08", None, 1),
        (None, None, 1),
    }


def test_window_bounds_are_inclusive_and_open_above(spark, tmp_path):
    """An order exactly 90 days old counts; so does one after as_of."""
    (tmp_path / "customers.csv").write_text(
        "customer_id,email,first_name,last_name,created_at,country,marketing_opt_in,nps_score\n"
        "1,a@x,A,A,2024-01-01,US,1,\n2,b@x,B,B,2024-01-01,US,1,9.5\n3,c@x,C,C,2024-01-01,US,1,2\n"
    )
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_ts,status,amount\n"
        "1,1,2024-01-01 00:00:00,paid,149.99\n2,1,2023-12-31 23:59:59,paid,1000\n"
        "3,2,2024-05-01 00:00:00,paid,0.1\n4,2,2024-01-07 00:00:00,paid,0.2\n5,3,2024-03-30 00:00:00,paid,150\n"
    )
    (tmp_path / "web_events.csv").write_text(
        "event_id,customer_id,event_type,event_ts,session_id\n"
        "1,2,v,2024-03-01 00:00:00,s\n2,2,v,2024-02-29 23:59:59,s\n3,2,v,2024-04-01 00:00:00,s\n"
    )
    tables = SeedTables(spark, str(tmp_path))
    rows = {r["customer_id"]: r for r in marts.customer_360(tables, "2024-03-31").collect()}
    assert (rows[1]["revenue_12wk"], rows[1]["revenue_90d"], rows[1]["lifetime_revenue"]) == (0.0, 149.99, 1149.99)
    assert (rows[2]["revenue_12wk"], rows[2]["revenue_90d"]) == (0.3, 0.3)
    assert rows[2]["nps_score"] == 10  # 9.5 rounds half to even
    assert rows[2]["events_30d"] == 2
    scores = {r["customer_id"]: (r["segment"], r["score"]) for r in marts.segment_scores(tables, "2024-03-31").collect()}
    assert scores[1][0] == UNCLASSIFIED  # 149.99 stays below the threshold, no NPS answer
    assert scores[3] == (LAPSE, 110.0)  # the first rule wins over the low NPS


def test_narrow_profile_equals_whole_profile(tables):
    whole = marts.customer_360(tables, "2024-06-30")
    for names in (["customer_id", "revenue_90d"], ["customer_id", "events_30d"], ["customer_id", "lifetime_revenue"]):
        narrow = marts.customer_360(tables, "2024-06-30", names)
        assert sorted(narrow.collect()) == sorted(whole.select(*names).collect())


def test_reports(tables):
    profile = marts.customer_360(tables, "2024-06-30")
    assert tuple(reports.kpis(profile).collect()[0]) == (6, 369.0, 6.2, 4)
    assert tuple(reports.kpis(profile, "NL").collect()[0]) == (2, 193.5, 7.0, 2)
    assert tuple(reports.kpis(profile, "FR").collect()[0]) == (0, None, None, 0)
    by_filter = {r["country_filter"]: r for r in reports.kpis_by_filter(profile).collect()}
    assert {k: r["total_revenue"] for k, r in by_filter.items()} == {"All": 369.0, "NL": 193.5, "PT": 175.5, "SE": 0.0}
    assert tuple(reports.kpi_display(reports.kpis(profile)).collect()[0]) == ("6", "$369", "6.2", "4")
    assert [r["customer_id"] for r in reports.top_active(profile, 3).collect()] == [15, 10, 11]
    classes = {r["category"]: r["customers"] for r in reports.nps_categories(profile).collect()}
    assert classes == {"Promoters": 1, "Passives": 2, "Detractors": 3}  # no answer counts as a detractor
    rounded = reports.rounded(reports.segment_performance(profile)).collect()
    assert {r["segment"]: (r["lifetime_revenue"], r["score"]) for r in rounded} == {
        UNCLASSIFIED: (80.1, 50.56),
        RESCUE: (16.65, 34.99),
        LAPSE: (175.5, 105.3),
        INTENT: (0.0, 10.0),
    }


def test_ad_spend(tables):
    assert staging.ad_spend(tables).agg(F.sum("spend")).collect()[0][0] == 510.75


def test_data_tests_pass_on_seeds(tables):
    rows = quality_suite.suite(quality_suite.models(tables, "2024-06-30")).collect()
    assert len(rows) == 9 and all(row["passed"] and row["failures"] == 0 for row in rows)


def test_bad_seed_fails_loudly(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id,customer_id,order_ts,status,amount\nx,1,2024-01-01 00:00:00,paid,1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|CAST"):
        staging.orders(SeedTables(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("kind", ["folders", "schema"])
def test_stored_marts_equal_lazy_ones(spark, tables, tmp_path, kind):
    as_of = "2024-06-30"
    if kind == "folders":
        store = warehouse.Folders(spark, str(tmp_path))
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}'")
        store = warehouse.Schema(spark, "marts", buckets=4)
    read = warehouse.build(tables, as_of, store)
    lazy = {
        "fct_orders": staging.fct_orders(tables),
        "fct_events": staging.fct_events(tables),
        "customer_360": marts.customer_360(tables, as_of),
        "dim_customer": marts.dim_customer(tables, as_of),
        "segment_scores": marts.segment_scores(tables, as_of),
        "cohort_retention": marts.cohort_retention(tables),
    }
    for name, frame in lazy.items():
        stored = read(name).select(*frame.columns)
        assert stored.dtypes == frame.dtypes
        assert sorted(stored.collect(), key=repr) == sorted(frame.collect(), key=repr), name
    # Joins of stored marts give what the join-free records give.
    records = marts.segment_records(read("customer_360"))
    joined = marts.segment_records_from_marts(read("segment_scores"), read("customer_360"))
    assert sorted(joined.collect(), key=repr) == sorted(records.collect(), key=repr)
    from_stored = marts.segment_scores(WarehouseTables(read), as_of)
    assert sorted(from_stored.collect()) == sorted(lazy["segment_scores"].collect())
    if kind == "schema":
        with_join = marts.segment_records_from_marts(read("segment_scores").hint("merge"), read("customer_360"))
        plan = with_join._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan  # buckets spare the shuffle
        spark.sql("DROP DATABASE marts CASCADE")
